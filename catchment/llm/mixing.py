"""Mixing sources to target weights by iterative proportional fitting. Native columns only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchment.llm.common import whole_text
from catchment.session import pin

OTHER = "other"


@dataclass(frozen=True)
class Targets:
    """Shares of tokens wanted by source, language and topic; what is not named is `other`.

    A share of 0 drops all rows of that name. So `other`, which holds unlabelled rows too, has a share like the rest.

    `topics` are rules, tried in order: (name, text to look for). The names bound the number of cells.
    """

    source: dict[str, float] = field(default_factory=lambda: {"src0": 0.1, OTHER: 0.9})
    lang: dict[str, float] = field(default_factory=lambda: {"en": 0.6, "de": 0.1, "fr": 0.1, "es": 0.1, OTHER: 0.1})
    topic: dict[str, float] = field(default_factory=lambda: {"table": 0.02, "contact": 0.02, OTHER: 0.96})
    topics: tuple[tuple[str, str], ...] = (("table", " | "), ("contact", "@"))
    rounds: int = 25
    seed: str = "mix-1"


def named(column: Column, shares: dict[str, float]) -> Column:
    return F.when(column.isin(*[name for name in shares if name != OTHER]), column).otherwise(F.lit(OTHER))


def topic_of(text: Column, targets: Targets) -> Column:
    rules = [(name, needle) for name, needle in targets.topics if name in targets.topic]
    topic = F.lit(OTHER)
    for name, needle in reversed(rules):
        topic = F.when(F.contains(text, F.lit(needle)), F.lit(name)).otherwise(topic)
    return topic


def features(
    docs: DataFrame, targets: Targets, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang"
) -> dict[str, Column]:
    text = whole_text(text_col)
    key = F.concat_ws("|", F.coalesce(docs[id_col].cast("string"), F.md5(text.cast("binary"))), F.lit(targets.seed))
    return {
        "_source": named(F.col(source_col), targets.source),
        "_lang": named(F.col(lang_col), targets.lang),
        "_topic": topic_of(text, targets),
        "_tokens": F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"),
        "_draw": F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0),
    }


def rake(cells: dict[tuple[str, ...], float], margins: list[dict[str, float]], rounds: int) -> dict[tuple[str, ...], float]:
    """Weights of the cells whose weighted sums meet each margin in turn, as far as the cells allow.

    Margins are shares; a name without tokens in any cell is left out and the others are scaled up.
    """
    weights = {cell: 1.0 for cell, tokens in cells.items() if tokens > 0}
    total = sum(cells[cell] for cell in weights)
    wanted = []
    for axis, margin in enumerate(margins):
        there = {cell[axis] for cell in weights}
        whole = sum(margin.get(name, 0.0) for name in there)
        wanted.append({name: margin.get(name, 0.0) / whole * total if whole > 0 else None for name in there})
    for _ in range(rounds):
        for axis, margin in enumerate(wanted):
            sums = dict.fromkeys(margin, 0.0)
            for cell in sorted(weights):
                sums[cell[axis]] += cells[cell] * weights[cell]
            for cell in weights:
                want, have = margin[cell[axis]], sums[cell[axis]]
                if want is not None and have > 0:
                    weights[cell] *= want / have
    return weights


def weighted(rows: DataFrame, targets: Targets) -> DataFrame:
    """`rows` with the cell columns and `_draw`, and with `_weight`, `_probability`, `_kept` added."""
    sums = rows.groupBy("_source", "_lang", "_topic").agg(F.sum("_tokens"))
    # At most (sources + 1) x (languages + 1) x (topics + 1) rows.
    cells = {(row[0], row[1], row[2]): float(row[3] or 0) for row in sums.collect()}
    weights = rake(cells, [targets.source, targets.lang, targets.topic], targets.rounds)
    largest = max(weights.values(), default=1.0)
    entries = [F.lit(item) for cell, weight in sorted(weights.items()) for item in ("|".join(cell), weight)]
    lookup = F.create_map(*entries) if entries else F.create_map(F.lit(""), F.lit(1.0))
    weight = F.coalesce(F.try_element_at(lookup, F.concat_ws("|", "_source", "_lang", "_topic")), F.lit(largest))
    return (
        rows.withColumn("_weight", weight)
        .withColumn("_probability", F.col("_weight") / F.lit(largest))
        .withColumn("_kept", F.col("_draw") < F.col("_probability"))
    )


def mix(
    docs: DataFrame,
    targets: Targets = Targets(),  # noqa: B008
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
) -> DataFrame:
    """All columns of `docs` and `_source`, `_lang`, `_topic`, `_tokens`, `_draw`, `_weight`, `_probability`, `_kept`.

    Tokens (words) are summed by cell of source, language and topic. The cells are bounded by the names in `targets`,
    so the raking itself works on a settings-sized table. The weights are scaled so that the largest is 1: each is then
    the probability with which a row stays, and the rows kept meet the targets in expectation. The cell that is scarcest
    against its target sets how much of all others stays, which may be less than half. The draw is a hash of the id (of the text where the id is NULL) and `targets.seed`.

    NULL sources and languages are `other`, NULL text has no tokens; a cell without tokens stays whole. Rows that
    repeat an id share their draw. Other columns stay as they are, and an empty table gives no rows.
    """
    return weighted(docs.withColumns(features(docs, targets, id_col, text_col, source_col, lang_col)), targets)


def mix_report(docs: DataFrame, targets: Targets = Targets()) -> DataFrame:  # noqa: B008
    """Each row's cell, weight, probability and whether it stays; the texts are read once."""
    light = pin(docs.select("doc_id", *[value.alias(name) for name, value in features(docs, targets).items()]))
    return weighted(light, targets).select(
        "doc_id",
        F.col("_source").alias("source_group"),
        F.col("_lang").alias("lang_group"),
        F.col("_topic").alias("topic"),
        F.col("_tokens").alias("n_tokens"),
        F.round("_weight", 6).alias("weight"),
        F.round("_probability", 6).alias("probability"),
        F.col("_kept").alias("kept"),
    )


def oracle(targets: Targets = Targets()) -> str:  # noqa: B008
    """The same as DuckDB SQL: one step of the raking after the other."""

    def grouped(column: str, shares: dict[str, float]) -> str:
        names = ", ".join(f"'{name}'" for name in shares if name != OTHER)
        return f"CASE WHEN {column} IN ({names}) THEN {column} ELSE '{OTHER}' END"

    topics = " ".join(f"WHEN contains(t, '{needle}') THEN '{name}'" for name, needle in targets.topics)
    steps = [
        "d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents)",
        f"f AS (SELECT doc_id, {grouped('source', targets.source)} AS s, {grouped('lang', targets.lang)} AS l, "
        f"CASE {topics} ELSE '{OTHER}' END AS p, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS n, "
        f"CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '|{targets.seed}'), 1, 8) AS BIGINT) / 4294967296.0 AS u FROM d)",
        "c0 AS (SELECT s, l, p, CAST(sum(n) AS DOUBLE) AS n, CAST(1 AS DOUBLE) AS w, sum(CAST(sum(n) AS DOUBLE)) OVER () AS total "
        "FROM f GROUP BY s, l, p HAVING sum(n) > 0)",
    ]
    step = 0
    for axis, shares in (("s", targets.source), ("l", targets.lang), ("p", targets.topic)):
        values = ", ".join(f"('{name}', CAST({share!r} AS DOUBLE))" for name, share in shares.items())
        steps.append(
            f"m_{axis} AS (SELECT k, share / sum(share) OVER () AS share FROM (VALUES {values}) v(k, share) WHERE k IN (SELECT {axis} FROM c0))"
        )
    for _ in range(targets.rounds):
        for axis in "slp":
            steps.append(
                f"c{step + 1} AS (SELECT s, l, p, n, total, CASE WHEN sum(n * w) OVER (PARTITION BY {axis}) > 0 AND m.share IS NOT NULL "
                f"THEN w * (m.share * total / sum(n * w) OVER (PARTITION BY {axis})) ELSE w END AS w FROM c{step} LEFT JOIN m_{axis} m ON m.k = {axis})"
            )
            step += 1
    steps = [item.replace(" AS (", " AS MATERIALIZED (", 1) if item.startswith("c") else item for item in steps]
    return (
        f"WITH {', '.join(steps)} SELECT doc_id, f.s AS source_group, f.l AS lang_group, f.p AS topic, f.n AS n_tokens, "
        "round(coalesce(w, top), 6) AS weight, round(coalesce(w, top) / top, 6) AS probability, u < coalesce(w, top) / top AS kept "
        f"FROM f LEFT JOIN c{step} c ON c.s = f.s AND c.l = f.l AND c.p = f.p, (SELECT coalesce(max(w), 1.0) AS top FROM c{step})"
    )
