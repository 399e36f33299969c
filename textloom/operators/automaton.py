"""Which of many words stand in which texts: one automaton for a block of words, run once over each text.

Words come to the driver in blocks of bounded rows and bytes and go along with the tasks of one pass
over the texts; all words together are bounded too, and more are an error. A task builds the block's
automaton (Aho-Corasick) once and reads each text once, whatever the number of words.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import accumulate

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_WORDS, BLOCK_BYTES, MOST_BYTES, PIECE_BYTES = 20_000, 1 << 20, 64 << 20, 1 << 20


class Automaton:
    """Which words occur in a text; a word may stand for several numbers."""

    def __init__(self, words: Iterable[tuple[str, int]]):
        owners: dict[str, list[int]] = {}
        for word, number in words:
            if word:
                owners.setdefault(word, []).append(number)
        self.machine = None
        self.numbers = list(owners.values())
        if owners:
            self.machine = ahocorasick.Automaton()
            for i, word in enumerate(owners):
                self.machine.add_word(word, i)
            self.machine.make_automaton()

    def found(self, text: str) -> set[int]:
        """The numbers of the words that occur."""
        if self.machine is None:
            return set()
        return {n for i in {i for _, i in self.machine.iter(text)} for n in self.numbers[i]}


def pieces(batch: pa.RecordBatch, most_bytes: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of at most so many bytes (a larger row alone), so that what is made of a piece in Python doesn't
    grow with the batch. Texts count as long as they are, whatever else a row has as much as in any other."""
    texts = [pc.fill_null(pc.binary_length(c), 0).to_pylist() for c in batch.columns if pa.types.is_string(c.type) or pa.types.is_large_string(c.type)]
    lengths = list(map(sum, zip(*texts, strict=True))) or [0] * batch.num_rows
    rest = max(batch.nbytes - sum(lengths), 0) // max(batch.num_rows, 1)
    ends = list(accumulate((n + rest for n in lengths), initial=0))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, bisect_right(ends, ends[at] + most_bytes) - 1)
        yield batch.slice(at, end - at)
        at = end


def blocks_of(rows: list, size: Callable, most: int = BLOCK_WORDS, most_bytes: int = BLOCK_BYTES) -> list[list]:
    """Rows in blocks of at most `most` of them and most_bytes by size(row) (a larger one alone); one block at least."""
    out: list[list] = [[]]
    held = 0
    for row in rows:
        n = size(row)
        if out[-1] and (len(out[-1]) == most or held + n > most_bytes):
            out.append([])
            held = 0
        out[-1].append(row)
        held += n
    return out


def checked_rows(words: DataFrame, what: str) -> list:
    """All rows, if their texts are small enough to go along with tasks."""
    sizes = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)).cast("long") for f in words.schema.fields]
    held = words.agg(F.sum(reduce(lambda a, b: a + b, sizes))).first()[0] or 0
    if held > MOST_BYTES:
        raise ValueError(f"{what}: {held} bytes, more than the {MOST_BYTES} that can go along with tasks")
    return words.collect()


def occurring(texts: DataFrame, text: str, words: DataFrame, most: int = BLOCK_WORDS) -> DataFrame:
    """The columns of texts but `text`, and word: each distinct word that stands in the text, letter by letter.

    words has a column word; null and empty words stand nowhere, null texts hold none.
    """
    kept = [c for c in texts.columns if c != text]
    rows = checked_rows(words.select("word").filter("word <> ''").distinct().orderBy("word"), "words")
    schema = texts.select(*kept).schema.add("word", "string")

    def one_pass(block: list[str]):
        def run(batches):
            machine = Automaton((w, i) for i, w in enumerate(block))
            for batch in (p for b in batches for p in pieces(b)):
                found = [sorted(machine.found(t)) if t else [] for t in batch.column(0).to_pylist()]
                own = pa.array([i for i, f in enumerate(found) for _ in f], pa.int64())
                hits = pa.array([block[n] for f in found for n in f], pa.string())
                yield pa.RecordBatch.from_arrays([*(c.take(own) for c in batch.columns[1:]), hits], names=[*kept, "word"])

        return texts.select(text, *kept).mapInArrow(run, schema)

    return reduce(DataFrame.unionAll, [one_pass(b) for b in blocks_of([r["word"] for r in rows], lambda w: len(w.encode()), most)])
