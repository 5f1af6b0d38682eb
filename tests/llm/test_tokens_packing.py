"""Token files and packing: exact round trips against the tokenizers library."""

import os
import random
import zlib

import numpy as np
import pytest

from roundbook.llm import encoding, packing, tokens

TEXTS = ["", None, "Hello world", "it's DON'T we'll 've", "Éçole ÀÖØ ß ÿ 12 345", "tab\tand\nline\r\n  end ", "<|endoftext|> x <|startoftext|>", "日本語 Ωσς ﬁ İstanbul é", "a" * 5000, "a.b,c;d!!! ###'s '''re", "x " * 3000, "\x1c\x85\xa0 sep"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(encoding.default_tokenizer())


def test_encoder_equals_the_library(library):
    encode = encoding.Encoder(encoding.default_tokenizer())
    rng = random.Random(5)
    made = ["".join(rng.choice("abcXYZ'sté ÀÿÜ129.,-!#<|>\n\t́ªº×") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    for t in [*filter(None, TEXTS), *made]:
        assert encode(t).tolist() == library.encode(t, add_special_tokens=False).ids, t


def want_ids(library, text, end):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_token_files_round_trip(spark, library):
    rows = [(i, t, "clash", 1.5) for i, t in enumerate(TEXTS)] + [(3, "repeat", "x", 0.0), (3, "repeat", "x", 0.0), (None, "no id", "x", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, d double").repartition(3)
    manifest = tokens.write_tokens(docs, encoding.default_tokenizer(), end_id=2, length=64)
    got = tokens.read_tokens(manifest, with_ids=True).orderBy("start").collect()
    assert len(got) == len(rows)
    ids = [r["doc_id"] for r in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    at = 0
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, []).append(want_ids(library, t, 2).tolist())
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids"] in texts[r["doc_id"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    shard = manifest.orderBy("part").first()
    reader = tokens.open_file(shard["tokens_uri"])
    first, mask = tokens.sequence(reader, 0)
    assert len(first) == 64 and len(mask) == 8 and not first.flags["OWNDATA"] and not mask.flags["OWNDATA"]
    at = lambda x: x.__array_interface__["data"][0]
    again = tokens.sequence(reader, 0)
    assert at(again[0]) == at(first) and at(again[1]) == at(mask)  # the file's own bytes
    count = sum(reader.get_batch(k).num_rows for k in range(reader.num_record_batches))
    assert sum(tokens.valid(tokens.sequence(reader, i)[1], 64).sum() for i in range(count)) == shard["n_tokens"]
    assert os.path.exists(shard["docs_uri"].replace("file://", ""))


def test_every_sequence_of_a_shard_is_found_by_its_number(tmpdir_path):
    rng = np.random.default_rng(4)
    length = 16
    batch = length * tokens.BATCH_SEQUENCES
    for tail in (0, 5, length):
        sizes = [batch - 10, 3 * length, 1, 5 * batch + 7, *rng.integers(1, 4 * length, 300).tolist(), 2 * batch, 90]
        sizes.append(-sum(sizes) % length + length + tail)
        writer, parts = tokens.ShardWriter(tmpdir_path, length, np.dtype(np.uint16)), []
        for i, n in enumerate(sizes):
            parts.append(rng.integers(1, 60_000, n).astype(np.uint16))
            writer.add(i, parts[-1])
        writer.close()
        want = np.concatenate(parts)
        reader = tokens.open_file(writer.uris[0])
        rows = [reader.get_batch(k).num_rows for k in range(reader.num_record_batches)]
        assert len(rows) > 8 and set(rows[:-1]) == {tokens.BATCH_SEQUENCES} and sum(rows) == -(-len(want) // length)
        for i in range(sum(rows)):
            ids, mask = tokens.sequence(reader, i)
            own = want[i * length : (i + 1) * length]
            assert len(ids) == length and ids[: len(own)].tolist() == own.tolist() and tokens.valid(mask, length).tolist() == [k < len(own) for k in range(length)]


def test_token_files_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.read_tokens(tokens.write_tokens(docs, encoding.default_tokenizer())).count() == 0


def test_plan_of_bins_is_whole_and_near_the_bound():
    rng = random.Random(3)
    for capacity in (7, 12, 100):
        for _ in range(150):
            sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
            counts = {n: sizes.count(n) for n in set(sizes)}
            plan = packing.plan_bins(counts, capacity)
            placed = [n for c, lengths in plan for n in lengths for _ in range(c)]
            assert sorted(placed) == sorted(sizes)
            assert all(sum(lengths) <= capacity for _, lengths in plan)
            large = [n for n in sizes if 3 * n > capacity]
            least = max(-(-sum(sizes) // capacity), sum(2 * n > capacity for n in large), -(-len(large) // 2))
            assert sum(c for c, _ in plan) <= least * 1.25 + 1


def test_packing_places_every_token_once(spark, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(5, "again"), (5, "again"), (None, "no id")] + [(100 + i, "same text") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    packed = packing.pack(packing.encode_pieces(docs, encoding.default_tokenizer(), capacity=128), capacity=128).collect()
    bins = {}
    for r in packed:
        assert r["length"] * 4 == len(r["ids"]) and r["length"] <= 128
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
    assert sum(r["length"] for r in packed) == sum(len(want_ids(library, t, 0)) for _, t in rows)
    whole = b"".join(r["ids"] for r in sorted((r for r in packed if r["doc_id"] == 8), key=lambda r: r["piece"]))
    assert whole == want_ids(library, TEXTS[8], 0).tobytes()
    again = packing.pack(packing.encode_pieces(docs, encoding.default_tokenizer(), capacity=128), capacity=128)
    sequences = packing.packed_sequences(again).collect()
    assert all(len(s["ids"]) == 4 * s["n_tokens"] <= 512 for s in sequences) and len(sequences) == len(bins)


def test_packing_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.encode_pieces(docs, encoding.default_tokenizer())).count() == 0
