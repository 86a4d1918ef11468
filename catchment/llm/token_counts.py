"""Token counts by a finite-state form of a byte-pair tokenizer.

The tokenizer is compiled, as far as texts ask for it, into a deterministic transducer. Its transitions carry how many
tokens the next character adds (or takes back, where it lets a merge happen). After each prefix of a word the last token
of the prefix's encoding is known; a token may follow another if the two stay apart when their characters are encoded
together. A state is what later characters can depend on: the open token starts, the token before each, and their counts.

No token spans a blank that follows another character, so there every state leads to the start. The state map of a chunk
is then its text before the first such place, the count between, and the text after the last one; maps compose
associatively, and a long text is the composition of its chunks by a scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.llm.common import whole_text

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
CHUNK = 1 << 20
#: Most words and states a task remembers; beyond that it begins anew. Results don't depend on it.
REMEMBER = 600_000


class StateMap(NamedTuple):
    """What a chunk does to any state it is entered with; `count` is None where no place leads to the start."""

    head: str
    count: int | None
    tail: str


class Transducer:
    """Counts of a tokenizer whose pieces have merge ranks; a character outside the pieces gives its bytes."""

    def __init__(self, ranks: dict[str, int], remember: int = REMEMBER) -> None:
        self.ranks = ranks
        self.prefixes = {piece[:end] for piece in ranks for end in range(1, len(piece))}
        self.singles = {piece for piece in ranks if len(piece) == 1}
        if any(piece[at] == " " and piece[at - 1] != " " for piece in ranks for at in range(1, len(piece))):
            raise ValueError("pieces that go on after a blank are not supported")
        self.remember = remember
        self.words: dict[str, int] = {}
        self.together: dict[tuple[str, str], bool] = {}
        self.forget()

    def forget(self) -> None:
        #: State 0 is the start: nothing is open.
        self.contents: list[tuple[tuple[str, str, int], ...]] = [(("", "", 0),)]
        self.numbers = {self.contents[0]: 0}
        self.steps: list[dict[str, tuple[int, int]]] = [{}]

    def merged(self, text: str) -> list[str]:
        """The tokens of a short text: the adjacent pair of best rank merges first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            found = [(rank, at) for at in range(len(parts) - 1) if (rank := self.ranks.get(parts[at] + parts[at + 1])) is not None]
            if not found:
                break
            at = min(found)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, before: str, piece: str) -> bool:
        key = (before, piece)
        known = self.together.get(key)
        if known is None:
            if len(self.together) > self.remember:
                self.together.clear()
            known = self.together[key] = self.merged(before + piece) == ([before, piece] if before else [piece])
        return known

    def compile(self, state: int, char: str) -> tuple[int, int]:
        """The transition from a state over a character: the next state and the count it adds."""
        if char not in self.singles:
            step = (0, len(char.encode()))
        else:
            added, last = 0, ""
            opened = []
            for text, before, count in self.contents[state]:
                longer = text + char
                if longer in self.ranks and self.follows(before, longer):
                    added, last = count + 1, longer
                if longer in self.prefixes:
                    opened.append((longer, before, count))
            content = (*((text, before, count - added) for text, before, count in opened), ("", last, 0))
            number = self.numbers.get(content)
            if number is None:
                number = self.numbers[content] = len(self.contents)
                self.contents.append(content)
                self.steps.append({})
            step = (number, added)
        self.steps[state][char] = step
        return step

    def word(self, text: str) -> int:
        """Tokens of a text taken from the start, character by character."""
        if len(self.contents) > self.remember:
            self.forget()
        state = total = 0
        steps = self.steps
        for char in text:
            step = steps[state].get(char)
            if step is None:
                step = self.compile(state, char)
            state, added = step
            total += added
        return total

    def count(self, text: str) -> int:
        """Tokens of any text taken from the start; words are remembered, as they begin and end there."""
        words, total = self.words, 0
        for piece in _WORDS.findall(text):
            known = words.get(piece)
            if known is None:
                known = self.word(piece)
                if len(piece) <= 64:
                    if len(words) > self.remember:
                        words.clear()
                    words[piece] = known
            total += known
        return total

    def chunk_map(self, chunk: str) -> StateMap:
        first = _RESET.search(chunk)
        if first is None:
            return StateMap(chunk, None, "")
        start, end = first.start() + 1, chunk.rindex(" ")
        while chunk[end - 1] == " ":
            end -= 1
        return StateMap(chunk[:start], self.count(chunk[start:end]) if end > start else 0, chunk[max(start, end) :])

    def compose(self, left: StateMap, right: StateMap) -> StateMap:
        if left.count is None and right.count is None:
            return StateMap(left.head + right.head, None, "")
        if right.count is None:
            return StateMap(left.head, left.count, left.tail + right.head)
        if left.count is None:
            return StateMap(left.head + right.head, right.count, right.tail)
        return StateMap(left.head, left.count + self.count(left.tail + right.head) + right.count, right.tail)

    def total(self, text: str, chunk: int = CHUNK) -> int:
        """Tokens of a whole text: the maps of its chunks are composed pairwise, level by level."""
        if len(text) <= chunk:
            return self.count(text)
        maps = [self.chunk_map(text[at : at + chunk]) for at in range(0, len(text), chunk)]
        while len(maps) > 1:
            maps = [self.compose(*maps[at : at + 2]) if at + 1 < len(maps) else maps[at] for at in range(0, len(maps), 2)]
        return self.count(maps[0].head) + (maps[0].count or 0) + self.count(maps[0].tail)


_WORDS = re.compile(" +[^ ]*|[^ ]+")
_RESET = re.compile("[^ ] ")


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """The compiled form of a sentencepiece byte-pair model; blanks stand for its mark of a blank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ranks = {}
    for number in range(model.get_piece_size()):
        if not (model.is_byte(number) or model.is_control(number) or model.is_unknown(number) or model.is_unused(number)):
            ranks[model.id_to_piece(number).replace("▁", " ")] = -model.get_score(number)
    return Transducer(ranks)


def normalised(text: str) -> str:
    """As the model does: one blank before a text that isn't empty, and its mark of a blank is a blank."""
    return " " + text.replace("▁", " ") if text else ""


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row, without begin and end tokens.

    NULL and empty texts have no tokens. Texts of any length are counted whole, chunk by chunk. Rows that repeat an id
    are rows like others, a NULL id stays NULL, other columns are ignored, and an empty table gives no rows.
    """
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path(MODEL)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = transducer(model)
        for batch in batches:
            totals = [counter.total(normalised(text.as_py())) for text in batch.column(2)]
            tokens = pa.array(totals, pa.int64())
            over = pa.array([total > limit for total in totals], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), tokens, over], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
