import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickerloom.llm import byte_bpe, host_rules, packing

from .conftest import EDGES

BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.load_ranks(BPE)


@pytest.fixture(scope="module")
def codec(ranks):
    return byte_bpe.Codec(ranks, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_perfect():
    for n in (0, 1, 2, 7, 500):
        keys = [f"k{i}".encode() for i in range(n)]
        hashed = byte_bpe.PerfectHash(keys)
        place = byte_bpe.lookup(hashed)
        assert [place(k) for k in keys] == list(range(n))
        assert sorted(hashed.slot_of.tolist()) == list(range(max(1, n)))


def test_repeated_keys_are_an_error():
    with pytest.raises(ValueError):
        byte_bpe.PerfectHash([b"a", b"a"])


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab 'sé\n\t  1.#日🎉tion"), max_size=60))
def test_encoding_equals_the_library_and_round_trips(codec, reference, text):
    ids = codec.encode(text)
    assert ids == reference.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_long_runs(codec, reference):
    for text in ("x" * 20_000, " " * 5000, "ab" * 4000, "\n \n" * 50):
        assert codec.encode(text) == reference.encode_ordinary(text)


def test_bpe_rows(edges, nothing, reference):
    got = sorted(map(tuple, byte_bpe.digests(edges, BPE, public_tokenizers.PATTERN).collect()), key=str)
    want = []
    for doc_id, text, *_ in EDGES:
        ids = reference.encode_ordinary(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert byte_bpe.digests(nothing, BPE, public_tokenizers.PATTERN).count() == 0


def test_encode_then_decode(edges):
    encoded = byte_bpe.encode(edges, BPE, public_tokenizers.PATTERN)
    got = byte_bpe.decode(encoded, BPE, public_tokenizers.PATTERN).collect()
    assert sorted((str(r[0]), bytes(r[1])) for r in got) == sorted((str(d), (t or "").encode()) for d, t, *_ in EDGES)


def test_words_equal_the_library():
    words, library = packing.Words(WORDS), Tokenizer.from_file(WORDS)
    for text in [t or "" for _, t, *_ in EDGES] + ["It's <|endoftext|>x ź ﬁ İx ½ ª, 'S we'Re", "\x1c a\x85b", "ŉ ǆ ß", "a,b.c!! ---", "…“x”"]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert words.encode(text) == np.array(ids, "<u4").tobytes(), text[:50]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40))
def test_first_fit_equals_the_plain_search(lengths):
    lengths = sorted(lengths, reverse=True)
    room, want = [], []
    for x in lengths:
        at = next((i for i, r in enumerate(room) if r >= x), len(room))
        if at == len(room):
            room.append(20)
        want.append((at, 20 - room[at]))
        room[at] -= x
    assert list(zip(*packing.first_fit(lengths, 20), strict=True)) == want


def test_packing_rows(edges, nothing):
    library = Tokenizer.from_file(WORDS)
    rows = packing.pack_documents(edges, WORDS, length=64, group_docs=3).collect()
    pieces = sorted((str(r["doc_id"]), r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows)
    want = []
    for doc_id, text, *_ in EDGES:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for i in range(0, len(ids), 64):
            part = ids[i : i + 64]
            want.append((str(doc_id), i, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)))
    assert pieces == sorted(want)
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack_documents(nothing, WORDS).count() == 0


def _measure(text):
    words, symbols = [], sum(c in "#*$%&|<>" for c in text)
    word = ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures_equal_brute_force():
    r = random.Random(5)
    for _ in range(300):
        text = "".join(r.choice(["a", "b ", "é", " ", "\n", "#", "a b c ", " ", "\x1c"]) for _ in range(r.randrange(60)))
        assert host_rules.measure(text) == _measure(text)
    assert host_rules.measure(None) == (0, 0, 0, 0, 0)


def test_hosts_shrink_and_reject(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "short" if i % 100 < 95 else good, "bad") for i in range(300)]
    rows += [(1000 + i, "short" if i < 3 else good, "good") for i in range(300)]
    rows += [(2000, "short", "tiny"), (3000, good, None), (3001, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in host_rules.apply_rules(docs).collect()}
    assert len(got) == len(rows)
    assert not got[99]["kept"] and not got[99]["base_failed"]  # a good text of a bad host
    assert got[1299]["kept"] and got[3000]["kept"] and not got[3001]["kept"]
    assert got[2000]["host_rate"] < 1.0  # one failure of one is shrunk


def test_hosts_without_spread_get_the_corpus_rate(spark):
    docs = spark.createDataFrame([(i, "x", f"h{i % 3}") for i in range(9)], "doc_id long, text string, source string")
    assert {r["host_rate"] for r in host_rules.apply_rules(docs).collect()} == {1.0}


def test_rules_on_edges(edges, nothing):
    assert host_rules.apply_rules(edges).count() == len(EDGES)
    assert host_rules.apply_rules(nothing).count() == 0
