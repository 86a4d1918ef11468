"""Default targets of the mixing."""

from catchment.llm import mixing


def test_unnamed_languages_are_not_dropped(documents):
    langs = ["en", "de", "fr", "es", "it", None]
    rows = [(number, f"some words {number}", langs[number % 6], "src0" if number % 5 == 0 else "src1") for number in range(300)]
    mixed = mixing.mix(documents(rows)).collect()
    assert all(row._probability > 0 for row in mixed)
    assert {row.lang for row in mixed if row._kept} == set(langs)


def test_no_default_share_is_nothing():
    targets = mixing.Targets()
    assert all(share > 0 for shares in (targets.source, targets.lang, targets.topic) for share in shares.values())
