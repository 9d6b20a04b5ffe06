import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import documents, none, prose, whole

from ledgerlake.llm import packing, tokens
from ledgerlake.llm.packing import _Search, best_fit, complete, fewest, pack
from ledgerlake.llm.queries import tokenizer
from ledgerlake.llm.rans import Codec, quantised, rans_round_trip, read_ids, write_ids
from ledgerlake.llm.tokens import WordEncoder


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer())


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_words_give_the_ids_of_whole_texts(library):
    rng = random.Random(5)
    alphabet = "aabcdeestT .,;!?'\"-*$0123éÉßİΣς́ \u0085\x1c\x0b\n日🙂<|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["it's. we'll, x'd'", "Àb K Σας ΟΔΟΣ. İx", "<|endoftext|> hi", "a <|EndOfText|> b", "", None, "a.́b ,. ok.́"]
    encoder = WordEncoder(tokenizer())
    assert encoder.by_word
    for part in (texts, texts[100:], texts[:1], []):
        ids, counts = encoder.encode(pa.array(part, pa.string()))
        want = [library.encode(t or "", add_special_tokens=False).ids for t in part]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("n", [1, 63, 64, 5000, 300_000])
def test_codec_round_trip_and_damage(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 49_407).astype("<u2")
    seen, counts = np.unique(ids, return_counts=True)
    freq, bits = quantised(seen.astype(np.int64), counts, 49_408)
    assert freq.sum() == 1 << bits and (freq[seen] > 0).all()
    codec = Codec(freq, bits)
    raw = codec.encode(ids, 17, [None, 5], [n - 1, 1])
    block = codec.open(raw)
    assert (block.start, block.docs, block.lengths.tolist()) == (17, [None, 5], [n - 1, 1])
    assert np.array_equal(block.ids(), ids)
    # parts decode on their own, in any order
    assert np.array_equal(block.part(len(block.places) - 1), ids[(len(block.places) - 1) * block.every * block.lanes :])
    for at in (10, len(raw) - 3):
        bad = bytearray(raw)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            codec.open(bytes(bad)).ids()


def test_file_round_trip(spark, library, tmp_path):
    docs = documents(spark, extra="start")
    path = str(tmp_path / "ids")
    write_ids(docs, path, tokenizer(), 2)
    rows = read_ids(spark, path, with_ids=True).collect()
    want = sorted((r["doc_id"] is not None, r["doc_id"] or 0, library.encode(r["text"] or "", add_special_tokens=False).ids + [2]) for r in docs.collect())
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, np.frombuffer(r["ids"], "<u4").tolist()) for r in rows)
    assert got == want
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert (r["start"], r["ids_crc32"]) == (at, zlib.crc32(r["ids"]))
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_no_documents(spark):
    assert whole(rans_round_trip(none(spark), tokenizer())) == []
    assert whole(pack(none(spark), tokenizer())) == []


def check_bins(lengths, capacity, bins):
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= capacity for b in bins)


def exact(lengths, capacity) -> int:
    """Fewest bins by trying everything."""
    best = len(lengths)

    def go(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(lengths):
            best = len(room)
            return
        for k in sorted({r: k for k, r in enumerate(room)}.values()):
            if room[k] >= order[i]:
                room[k] -= order[i]
                go(i + 1, room)
                room[k] += order[i]
        room.append(capacity - order[i])
        go(i + 1, room)
        room.pop()

    order = sorted(lengths, reverse=True)
    go(0, [])
    return best


def test_bin_completion_is_as_good_as_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        capacity = rng.choice([10, 20, 50])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 9))]
        bins = complete(lengths, capacity)
        check_bins(lengths, capacity, bins)
        assert len(bins) == exact(lengths, capacity) if lengths else bins == []


def test_bin_completion_improves_on_best_fit():
    lengths = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6]  # best-fit decreasing needs one bin more than the total
    better = 0
    rng = random.Random(9)
    for _ in range(60):
        lengths = [rng.randint(20, 70) for _ in range(60)]
        bins = complete(lengths, 100)
        check_bins(lengths, 100, bins)
        plain = best_fit(sorted(lengths, reverse=True), 100)
        assert fewest(lengths, 100) <= len(bins) <= len(plain)
        better += len(bins) < len(plain)
    assert better


def test_fillings_of_many_short_pieces():
    # 142 pieces of 7 leave a waste of 2, 140 and five of 4 none
    fillings = _Search([7] * 200 + [4] * 50, 1000, 1).fillings(1000, 1000)
    assert fillings[0][0] == 0 and len(fillings) > 1


def test_the_search_of_long_pieces():
    rng = random.Random(1)
    lengths = [rng.randint(300, 1000) for _ in range(300)]
    bins = complete(lengths, 2048)
    check_bins(lengths, 2048, bins)
    assert len(bins) <= 97  # a search of 4000 nodes and 100 steps ends with 98


def test_pack(spark, library):
    docs = documents(spark, extra="offset")
    rows = pack(docs, tokenizer(), capacity=256, with_ids=True).collect()
    want = []
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        want += [(r["doc_id"], k, 256 * k, len(ids[256 * k : 256 * k + 256]), crc(ids[256 * k : 256 * k + 256])) for k in range(-(-len(ids) // 256))]
    key = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted([tuple(r[:5]) for r in rows], key=key) == sorted(want, key=key)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= -(-sum(r["length"] for r in rows) // 256) + 1


def test_the_emptiest_sequences_of_groups_are_packed_together(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 40)
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, prose(i, rng.randint(20, 400))) for i in range(800)], "doc_id long, text string")
    rows = pack(docs, tokenizer(), capacity=4096).collect()
    assert len({(r["doc_id"], r["piece"]) for r in rows}) == len(rows) and {r["doc_id"] for r in rows} == set(range(800))
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 4096
    floor = fewest([r["length"] for r in rows], 4096)
    # twenty groups alone end up to one sequence each over their own floors, which are rounded up, too
    assert floor <= len(bins) <= floor + 7


def test_refuted_remainders_change_no_result():
    rng = random.Random(5)
    for _ in range(40):
        lengths = [rng.randint(15, 60) for _ in range(14)]
        bins = complete(lengths, 100)
        check_bins(lengths, 100, bins)
        assert len(bins) == exact(lengths, 100)


def test_the_word_cache_is_bounded(monkeypatch, library):
    monkeypatch.setattr(tokens, "CACHE_BYTES", 20_000)
    enc = tokens.WordEncoder(tokenizer())
    texts = [prose(i, 200) + f" w{i}x{i * i}y" * 3 for i in range(50)]
    ids, counts = enc.encode(pa.array(texts))
    assert 0 < len(enc.cache) < 200 and enc.cached <= 20_000
    again, _ = enc.encode(pa.array(texts))
    assert np.array_equal(ids, again) and ids.tolist() == [i for t in texts for i in library.encode(t, add_special_tokens=False).ids]


def test_many_equal_pieces(spark):
    docs = spark.createDataFrame([(1, prose(4, 40))] * 9000, "doc_id long, text string")
    rows = pack(docs, tokenizer()).groupBy("sequence_id").agg({"length": "sum"}).collect()
    length = pack(docs.limit(1), tokenizer()).first()["length"]
    assert len(rows) <= -(-9000 // (2048 // length)) + 3
