"""Token counts by a compiled finite-state tokenizer.

The BPE of a word is a deterministic transducer over the word's bytes: a state holds, for every
position from which the bytes read so far may still grow into a longer token, the last token of the
encoding that ends there and its token count against the whole prefix. A token sequence is the
BPE's own exactly when each neighbouring pair is, so a transition finds the one token that ends at
the new byte and fits what stands before it; it is annotated with the tokens that it adds. States
are compiled when first met and kept up to a limit. White space resets the machine, so a chunk of
text maps an entry state to (count, exit state) by its text before the first and after the last
reset; these maps compose associatively and are combined in a scan of logarithmic depth.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import portions
from .common import small_batches, table, text_or_empty, tidy

FINAL = 256  # added to a word's last byte, which carries the word's end


def byte_of_char() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: visible Latin-1 as is, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Transducer:
    """Counts the tokens of words for a BPE with an end-of-word suffix."""

    def __init__(self, model: dict, max_states: int = 100_000, max_words: int = 300_000):
        of, suffix = byte_of_char(), model["end_of_word_suffix"]

        def symbols(token: str) -> str:
            if token.endswith(suffix) and len(token) > len(suffix):
                body = token[: -len(suffix)]
                return "".join(chr(of[c]) for c in body[:-1]) + chr(FINAL + of[body[-1]])
            return "".join(chr(of[c]) for c in token)

        self.tokens = {symbols(t) for t in model["vocab"]}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(symbols(a), symbols(b)): i for i, (a, b) in enumerate(pairs)}
        self.prefixes = {t[:i] for t in self.tokens for i in range(1, len(t))}
        self.max_states, self.max_words = max_states, max_words
        self.words: dict[str, int] = {}
        self.forget()

    def forget(self) -> None:
        self.ids = {((("", "", 0)),): 0}
        self.states = [(("", "", 0),)]
        self.to: dict[int, tuple[int, int]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        parts = list(text)
        while len(parts) > 1:
            rank, i = min((self.rank.get((parts[i], parts[i + 1]), 1 << 30), i) for i in range(len(parts) - 1))
            if rank == 1 << 30:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def fits(self, before: str, token: str) -> bool:
        key = (before, token)
        known = self.pairs.get(key)
        if known is None:
            known = self.pairs[key] = self.merged(before + token) == ([before, token] if before else [token])
        return known

    def compile(self, state: int, symbol: int) -> tuple[int, int]:
        """The transition's target and the tokens that it adds."""
        c = chr(symbol)
        live = self.states[state]
        for grown, before, count in live:
            token = grown + c
            if token in self.tokens and self.fits(before, token):
                break
        else:
            raise ValueError("no token of the vocabulary ends here")
        added = count + 1
        if symbol >= FINAL:
            target = 0
        else:
            entry = tuple((g + c, b, n - added) for g, b, n in live if g + c in self.prefixes) + (("", token, 0),)
            target = self.ids.setdefault(entry, len(self.states))
            if target == len(self.states):
                self.states.append(entry)
        self.to[state << 9 | symbol] = target, added
        return target, added

    def count_word(self, word: str) -> int:
        if len(self.states) > self.max_states:
            self.forget()
        raw, state, total, to = word.encode(), 0, 0, self.to
        for b in raw[:-1]:
            found = to.get(state << 9 | b)
            state, added = found if found is not None else self.compile(state, b)
            total += added
        key = raw[-1] + FINAL
        found = to.get(state << 9 | key)
        return total + (found if found is not None else self.compile(state, key))[1]

    def count_words(self, words: list[str]) -> int:
        known = self.words
        try:
            return sum(map(known.__getitem__, words))
        except KeyError:
            pass
        new = set(words).difference(known)
        if len(known) + len(new) > self.max_words:
            known.clear()
            new = set(words)
        count = self.count_word
        known.update((w, count(w)) for w in new)
        return sum(map(known.__getitem__, words))


class Counter:
    """The whole tokenizer of a .json file: special strings, normal form, words, transducer."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.machine = Transducer(spec["model"])
        library = Tokenizer.from_file(path)
        self.normal, self.pre, self.byte = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str, byte_of_char()
        self.odd: dict[str, bool] = {}
        self.split = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if "pattern" in p)).findall
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = special
        self.cut = regex.compile("|".join(map(regex.escape, special))).split if special else None
        self.plain = regex.compile("[^\\x00-\\u02ff]").search

    def library_words(self, text: str) -> list[str]:
        return [bytes(self.byte[c] for c in w).decode() for w, _ in self.pre(text)]

    def words_of(self, text: str) -> list[str]:
        """Words of a text with any characters; where the two libraries' Unicode tables differ on one, the tokenizer's hold."""
        for c in set(text).difference(self.odd):
            probe = f"a{c}a 1{c}1 !{c}!"
            self.odd[c] = self.split(probe) != self.library_words(probe)
        return self.library_words(text) if any(map(self.odd.__getitem__, set(text))) else self.split(text)

    def count(self, text: str) -> int:
        """Tokens of a text that begins and ends at a reset."""
        parts = self.cut(text) if self.special and any(s in text for s in self.special) else [text]
        total = len(parts) - 1
        for part in parts:
            # up to U+02FF a text is in normal form C and lower case goes by single characters
            words = self.split(part.lower()) if self.plain(part) is None else self.words_of(self.normal(part))
            total += self.machine.count_words(words)
        return total

    def chunk_map(self, text: str) -> tuple[str, int, str, bool]:
        """(text before the first reset, tokens between, text after the last reset, whether there is one)."""
        first = text.find(" ")
        if first < 0:
            return text, 0, "", False
        last = text.rfind(" ") + 1
        return text[:first], self.count(text[first:last]), text[last:], True

    def compose(self, a, b):
        if a[3] and b[3]:
            return a[0], a[1] + self.count(a[2] + b[0]) + b[1], b[2], True
        if b[3]:
            return a[0] + b[0], b[1], b[2], True
        return (a[0], a[1], a[2] + b[0], True) if a[3] else (a[0] + b[0], 0, "", False)

    def scan(self, maps: list) -> int:
        """The composed map's tokens, halving the list until one map is left."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return sum(self.count(t) if t else 0 for t in (maps[0][0], maps[0][2])) + maps[0][1] if maps else 0


_counters: dict[str, Counter] = {}


def _counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, chunk: int = 1 << 19) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row, over its whole text.

    path names a tokenizer .json (BPE with an end-of-word suffix) that every executor can open. A
    null text is empty: 0 bytes, 0 tokens. Special strings inside texts are one token each. Rows
    with repeated or null doc_id are each counted; other columns are dropped; an empty table gives
    an empty one. A text of more than `chunk` code points is read in chunks by several tasks, whose
    state maps are composed in order.
    """
    small_batches(docs.sparkSession)
    text = text_or_empty()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    long = F.col("n_bytes") > chunk
    pieces = F.transform(F.sequence(F.lit(0), F.floor(F.length("text") / F.lit(chunk)).cast("int")), lambda i: F.substr("text", i * chunk + 1, F.lit(chunk)))

    @tidy
    def maps(batches):
        counter = _counter(path)
        for batch in batches:
            texts, chunked = batch.column(4).to_pylist(), batch.column(2).to_pylist()
            for start, stop in portions(texts):
                got = [counter.chunk_map(t) if n else ("", counter.count(t), "", True) for t, n in zip(texts[start:stop], chunked[start:stop], strict=True)]
                heads, counts, tails, resets = zip(*got, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(start, stop - start) for i in (0, 1, 5, 3)), pa.array(heads, pa.string()), pa.array(counts, pa.int64()), pa.array(tails, pa.string()), pa.array(resets)],
                    names=["row", "doc_id", "n_bytes", "no", "head", "count", "tail", "reset"],
                )

    parts = rows.select("row", "doc_id", long.alias("chunked"), F.posexplode(F.when(long, pieces).otherwise(F.array("text"))).alias("no", "text"), "n_bytes")
    parts = parts.select("row", "doc_id", "chunked", "no", "text", "n_bytes")
    mapped = parts.mapInArrow(maps, "row long, doc_id long, n_bytes long, no int, head string, count long, tail string, reset boolean")
    each = mapped.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), F.array_sort(F.collect_list(F.struct("no", "head", "count", "tail", "reset"))).alias("maps"))

    @tidy
    def scans(batches):
        counter = _counter(path)
        for batch in batches:
            counts = [counter.scan([(m["head"], m["count"], m["tail"], m["reset"]) for m in maps]) for maps in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    out = each.select("doc_id", "n_bytes", "maps").mapInArrow(scans, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op4_token_counts(spark, sf_dir):
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
