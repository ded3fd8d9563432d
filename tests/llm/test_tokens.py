"""Counting, packing and storing tokens against the tokenizers library itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from captide.llm import packing, token_counts, token_store, vocab
from captide.llm.vocab import WHITE, UnitEncoder
from captide.session import shared_folder

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    None,
    "",
    " ",
    "a",
    "The cat's  hat \n\n and\t\ttab \r\n end  ",
    "x<|endoftext|>y <|endoftext|> z  <|endoftext|>",
    "a\x1cb !\x1c? \x85 \xa0 x　 y​z﻿",
    "é ́ Å ẛ̣ ΑΣ σς İI ŒÆ",
    "1234 12a3 '' 's 'll don't DON'T",
    "日本語 テキスト 🙂🙂 naïve",
    "word " * 3000 + "end",
    "x" * 5000,
]


def library(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def texts(rng, n):
    alphabet = [" ", "  ", "\n", "\t", " ", " ", "\x1f", "'s", "A", "é", "é", "9", "!", "the", "And", "|", "日", "\x00"]
    return ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_units_give_the_ids_of_the_library(path):
    ours, theirs = UnitEncoder(path), library(path)
    for text in texts(random.Random(1), 3000):
        assert np.frombuffer(ours.ids(text or ""), "<u4").tolist() == theirs(text)
        assert ours.count(text or "", {"The": 1}) == len(theirs(text))


def test_white_space_is_the_librarys():
    import re

    theirs = library(BYTE)
    ours = UnitEncoder(BYTE)
    odd = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000 and (chr(c).isspace() or re.match(f"[{WHITE}]", chr(c)))]
    for char in [*odd, "᠎", "​", "⁠"]:
        for text in (f"a{char}b", f"a {char}b", f"a{char} b", f"a{char}{char} {char}b{char}"):
            assert np.frombuffer(ours.ids(text), "<u4").tolist() == theirs(text)


def frame(spark, values):
    rows = [(i, t, "x", i) for i, t in enumerate(values)] + [(1, "again the same", "y", 0), (1, "again the same", "y", 0)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, start bigint")


def test_counts(spark):
    docs, theirs = frame(spark, texts(random.Random(2), 200)), library(BYTE)
    got = sorted(tuple(r) for r in token_counts.count_tokens(docs, BYTE).collect())
    assert got == sorted((r.doc_id, len((r.text or "").encode()), len(theirs(r.text))) for r in docs.collect())
    assert token_counts.count_tokens(docs.limit(0), BYTE).collect() == []


def test_summary_keeps_heavy_units():
    from collections import Counter

    counts = Counter({"a": 100, "b": 60, **{str(i): 1 for i in range(1000)}})
    assert list(token_counts.prune(counts, 2)) == ["a", "b"]


def test_subset_sum_against_all_subsets():
    rng = random.Random(3)
    for _ in range(300):
        room = rng.randrange(1, 60)
        lengths = [(n, rng.randrange(1, 4)) for n in rng.sample(range(1, 40), 4) if n <= room]
        reach = {0}
        for n, count in lengths:
            reach |= {s + k * n for s in reach for k in range(count + 1) if s + k * n <= room}
        chosen = packing.fullest(lengths, room)
        assert sum(n * c for n, c in chosen.items()) == max(reach)
        assert all(c <= dict(lengths)[n] for n, c in chosen.items())


@pytest.mark.parametrize("capacity,window", [(64, 8), (2048, 4096)])
def test_packing(spark, capacity, window):
    docs, theirs = frame(spark, texts(random.Random(4), 300)).where("doc_id != 1").repartition(3), library(WORD)
    pieces = packing.pack_documents(docs, WORD, 1, capacity=capacity, window=window).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) // 4 > 0
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for row in docs.collect():
        own = sorted(by_doc.pop(row.doc_id), key=lambda p: p.start)
        ids = theirs(row.text) + [1]
        assert [i for p in own for i in np.frombuffer(p.ids, "<u4").tolist()] == ids
        assert [p.start for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        assert {p.doc_tokens for p in own} == {len(ids)}
    assert not by_doc
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        total = sum(p.length for p in own)
        assert total == capacity or total & (total - 1) == 0
    assert packing.pack_documents(docs.limit(0), WORD, 1).collect() == []


def test_store_round_trip(spark, monkeypatch):
    monkeypatch.setattr(token_store, "TEXT_BYTES_PER_FILE", 4000)
    docs, theirs = frame(spark, texts(random.Random(5), 300)), library(WORD)
    folder = shared_folder(spark, "tokens")
    manifest = token_store.write_tokens(docs, folder, WORD, 2)
    assert manifest.count() > 3
    expected, start = [], 0
    for row in sorted(docs.collect(), key=lambda r: (r.doc_id, r.text is not None, r.text or "")):
        ids = theirs(row.text) + [2]
        expected.append((row.doc_id, start, ids))
        start += len(ids)
    got = token_store.read_tokens(spark, folder, manifest).collect()
    assert sorted((r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == sorted(expected)
    empty = shared_folder(spark, "tokens")
    assert token_store.write_tokens(docs.limit(0), empty, WORD, 2).collect() == []


def test_any_id_is_read_alone():
    rng = np.random.default_rng(6)
    ids = np.concatenate([rng.integers(0, 2**k, 900, dtype=np.int64) for k in (4, 8, 9, 16, 17, 32)]).astype(np.uint32)
    rng.shuffle(ids)
    stored = token_store.TokenFile(token_store.encode(ids, np.array([5, 9]), np.array([100, len(ids)])))
    assert [stored.token(i) for i in range(len(ids))] == ids.tolist()
    for _ in range(200):
        a, b = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
        assert stored.tokens(a, b).tolist() == ids[a:b].tolist()
    assert stored.doc_ids.tolist() == [5, 9] and stored.ends.tolist() == [100, len(ids)]
    assert zlib.crc32(stored.tokens(0, 10).astype("<u4").tobytes()) == zlib.crc32(ids[:10].astype("<u4").tobytes())


def test_a_file_is_written_without_copies_of_its_ids():
    import tracemalloc

    import numpy as np

    from captide.llm import token_store

    ids = (np.arange(4_000_000, dtype=np.uint32) * 2654435761) % 50_000
    ends = np.arange(1, 5, dtype=np.uint64) * 1_000_000
    tracemalloc.start()
    size = sum(memoryview(part).nbytes for part in token_store.encoded(ids, np.arange(4), ends))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    stored = token_store.TokenFile(token_store.encode(ids, np.arange(4), ends))
    assert len(stored.data) == size and peak < 2 * ids.nbytes
    assert (stored.tokens(999_000, 1_001_000) == ids[999_000:1_001_000]).all()
    assert [stored.token(i) for i in (0, 1, 3_999_999)] == ids[[0, 1, -1]].tolist()


def test_units_of_a_worker(monkeypatch):
    worker = vocab.UnitEncoder(public_tokenizers.path("word_bpe_49k.json"))
    words = ["Straße", "ÀÉÿ", "abc.", "abc..", "don't", "a1b", "<|endoftext|>", "é\u0301", "ªµº", "İx", "日本", "x;", "?", "'s"]
    assert worker.letters is not None
    for word in words:
        assert worker.encoded([word.encode()])[word.encode()] == np.array(worker.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
    # A unit is kept from its second time on, and no more than the bound are.
    monkeypatch.setattr(vocab, "CACHE_UNITS", 4)
    assert worker.ids("once twice") and b"once" not in worker.cache
    assert worker.ids("twice") and b"twice" in worker.cache and b"once" not in worker.cache
    text = " ".join(f"w{i}" for i in range(50))
    assert worker.ids(text) == worker.ids(text) and len(worker.cache) <= 4
