import base64
import random
import unicodedata

import public_tokenizers as P
import tiktoken
from tokenizers import Tokenizer

from textloom.llm import bpe, tokencount

ODD = ["", None, " ", "a", "hello  world\n\n x", "é" * 200, "a" * 3000, "it's WE'LL 's''t", "İstanbul ΑΣ Σ ﬁ x", "<|endoftext|>hi<|startoftext|", "日本語🎉1234!!??", "\x1c\x85  z", "ththth" * 30]


def samples(n=250):
    rng = random.Random(5)
    chars = "theandiongersé's  1!\n🎉"
    return ODD + ["".join(rng.choice(chars) for _ in range(rng.randint(1, 90))) for _ in range(n)]


def test_bpe_equals_library(spark):
    path, pattern = bpe.vocabulary()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rows = list(enumerate(samples()))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as ids", "2 as decoded")
    got = {r["doc_id"]: r for r in bpe.decode_ids(bpe.encode_documents(df, path, pattern), path).collect()}
    for i, t in rows:
        assert list(got[i]["ids"]) == library.encode_ordinary(t or "") and bytes(got[i]["decoded"]) == (t or "").encode()
    assert bpe.encode_documents(df.limit(0), path, pattern).count() == 0


def test_bpe_with_characters_of_newer_tables(spark):
    """Letters, numbers and other signs that the two libraries' Unicode tables class differently."""
    path, pattern = bpe.vocabulary()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    coder = bpe._encoder(path, pattern)
    classes = bpe.CharClasses()
    odd = [c for c in map(chr, [*range(0x300, 0xD800), *range(0xE000, 0x20000, 3), *range(0x20000, 0x32400, 50)]) if classes.stand_ins(c)]
    assert len(odd) > 500
    rng = random.Random(2)
    texts = ["\U00018dbc't", "\U00018e1a\u95d6", "\U0001df5a\u9699", "\U00010eda\u9c00"]
    texts += ["".join(rng.choice([rng.choice(odd), rng.choice("ab1 !'tsé\u95d6")]) for _ in range(rng.randint(1, 8))) for _ in range(4000)]
    assert coder.encode_batch(texts) == [library.encode_ordinary(t) for t in texts]
    assert not any(classes.kind(c) != {"L": "a", "N": "1"}.get(unicodedata.category(c)[0], "" if c.isspace() else "!") for c in map(chr, range(0xA0, 0x300)))


def test_bpe_repeated_and_null_ids(spark):
    path, pattern = bpe.vocabulary()
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a"), (None, None)], "doc_id long, text string")
    assert sorted(len(r["ids"]) for r in bpe.encode_documents(df, path, pattern).collect()) == [0, 1, 2, 2]


def test_bpe_forgets_and_merges_alike():
    path, pattern = bpe.vocabulary()
    tokens = bpe.read_ranks(path)
    small, large = bpe.Encoder(tokens, pattern, max_known=5), bpe.Encoder(tokens, pattern)
    for t in samples(60):
        assert small.encode_batch([t or ""]) == large.encode_batch([t or ""])
    rng = random.Random(1)
    pieces = [bytes(rng.choice(b"abcdefthe") for _ in range(rng.randint(2, 32))) for _ in range(200)]
    assert large.merge_many(pieces, 32) == [large.merge_long(p) for p in pieces]


def test_counts_equal_library(spark):
    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = list(enumerate(samples()))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as n_tokens", "2 as row")
    want = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in rows}
    for chunk in (1 << 19, 40):
        got = {r["doc_id"]: r for r in tokencount.count_tokens(df, path, limit=20, chunk=chunk).collect()}
        assert {i: r["n_tokens"] for i, r in got.items()} == want
        assert all(r["over_limit"] == (r["n_tokens"] > 20) and r["n_bytes"] == len((rows[i][1] or "").encode()) for i, r in got.items())
    repeated = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a")], "doc_id long, text string")
    assert sorted(r["n_tokens"] for r in tokencount.count_tokens(repeated, path).collect()) == [1, 2, 2]
    assert tokencount.count_tokens(repeated.limit(0), path).count() == 0


def test_chunk_maps_compose():
    c = tokencount.Counter(P.path("word_bpe_49k.json"))
    for t in [x for x in samples(80) if x]:
        for k in (1, 3, 8):
            assert c.scan([c.chunk_map(t[i : i + k]) for i in range(0, len(t), k)]) == c.count(t)


def test_states_are_forgotten_safely():
    spec = tokencount.Counter(P.path("word_bpe_49k.json"))
    spec.machine.max_states, spec.machine.max_words = 30, 10
    full = tokencount.Counter(P.path("word_bpe_49k.json"))
    assert all(spec.count(t or "") == full.count(t or "") for t in samples(100))
