"""op9 and op7: ids as the library gives them, decoding, file format, checksums, index."""

import os
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest

from runway.llm import bpe, records

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.load(PATH)


def texts(lorem):
    return [(5, "It's the THIRD test, isn't it?! 2024"), (1, None), (2, ""), (3, " \n\t "), (9, "café naïve École İ ΣΣ ß"),
            (4, "a b c\x1cd\x85e\x0bf"), (7, "<|startoftext|>hello<|endoftext|> <|ENDOFTEXT|>"), (8, "你好 \U0001f600\U0001f601 สวัส"),
            (6, lorem(20_000)), (10, "x" * 5000), (11, "dup dup"), (11, "dup dup"), (None, "no id"), (12, "́ starts with a mark"), (13, "'s 't ''s !'s it's'")]


def expected(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("block_bytes", [12 << 20, 3000])
def test_bpe_round_trip(make_docs, lorem, tokenizer, monkeypatch, block_bytes):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", block_bytes)
    pairs = texts(lorem)
    out = bpe.encode(make_docs(pairs), PATH).withColumn("decoded", bpe.decode("ids", PATH)).collect()
    got = sorted(((r["doc_id"], list(r["ids"]), r["decoded"]) for r in out), key=str)
    want = [(d, expected(tokenizer, t), tokenizer.decode(expected(tokenizer, t), skip_special_tokens=False)) for d, t in pairs]
    assert got == sorted(want, key=str)


def test_bpe_empty_table(make_docs):
    assert bpe.encode(make_docs([]), PATH).count() == 0


def slow_crc32c(data):
    crc = 0xFFFFFFFF
    for b in data:
        crc ^= b
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_crc32c():
    rng = np.random.default_rng(5)
    parts = [rng.bytes(n) for n in (0, 1, 2, 3, 4, 5, 8, 9, 1020, 1023, 1024, 1025, 3000)] + [b"123456789", b"\0" * 7, b"\0" * 2000]
    assert records.crc32c(parts).tolist() == [slow_crc32c(p) for p in parts]
    assert int(records.crc32c([b"123456789"])[0]) == 0xE3069283


def test_frames():
    payloads = [b"abc", b"", b"x" * 3000]
    data = records.frame(payloads)
    assert [p for _, p in records.unframe(data)] == [b"abc", b"x" * 3000]
    crc = slow_crc32c(b"abc")
    assert struct.unpack_from("<QI", data)[0] == 3
    assert struct.unpack_from("<I", data, 15)[0] == ((crc >> 15 | crc << 17 & 0xFFFFFFFF) + 0xA282EAD8) & 0xFFFFFFFF
    for at in (0, 9, 13, 16):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(records.unframe(bytes(broken)))
    with pytest.raises(ValueError):
        list(records.unframe(data[:-1]))


@pytest.mark.parametrize("file_bytes", [24 << 20, 20_000])
def test_files_and_index(spark, make_docs, lorem, tokenizer, monkeypatch, file_bytes):
    monkeypatch.setattr(records, "FILE_BYTES", file_bytes)
    monkeypatch.setattr(records, "RUN_BYTES", 3000)
    pairs = texts(lorem) + [(100 + i, lorem(50)) for i in range(50)]
    folder, index = records.encode_to_files(make_docs(pairs), PATH, end_id=2)
    rows = index.orderBy("start").collect()
    assert len(rows) == len(pairs)
    key = lambda d: (d is not None, d)
    assert [r["doc_id"] for r in rows] == sorted((d for d, _ in pairs), key=key)
    before, by_id = 0, dict(pairs)
    for r in rows:
        ids = expected(tokenizer, by_id[r["doc_id"]]) + [2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (before, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        before += len(ids)
        # a shuffled reader: straight to the record
        with open(r["file"].removeprefix("file:"), "rb") as f:
            f.seek(r["offset"])
            head = f.read(12)
            assert struct.unpack_from("<Q", head)[0] == r["length"]
            doc, found = records.parse(f.read(r["length"]))
        assert doc == r["doc_id"] and found.tolist() == ids
    with_ids = {(r["part"], r["offset"]): list(r["ids"]) for r in records.read_records(spark, folder, ids=True).collect()}
    assert all(with_ids[r["part"], r["offset"]][-1] == 2 for r in rows)
    assert os.path.isdir(folder.removeprefix("file:"))


def test_large_files_are_read_in_splits_and_missing_runs_are_seen(spark, make_docs, lorem, monkeypatch):
    import struct as st
    monkeypatch.setattr(records, "RUN_BYTES", 2000)
    pairs = [(i, lorem(150)) for i in range(300)]
    folder = records.shared_path(spark, "records-test")
    records.write_records(make_docs(pairs), PATH, folder, end_id=2)
    whole = sorted(map(tuple, records.read_records(spark, folder).collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")            # splits begin anywhere in a run, a record or a separator
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        split = records.read_records(spark, folder)
        assert split.rdd.getNumPartitions() > 30
        assert sorted(map(tuple, split.collect())) == whole and len(whole) == 300
        assert records.build_index(spark, folder).agg({"start": "max"}).first()[0] > 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    local = folder.removeprefix("file:")
    name = next(n for n in os.listdir(local) if n.startswith("part-"))
    data = open(f"{local}/{name}", "rb").read()
    parts = data.split(records.EMPTY)
    assert st.unpack_from("<Bqq", parts[3], 12)[1] == data.index(parts[3])
    for cut in (records.EMPTY.join(parts[:5] + parts[6:]), records.EMPTY.join(parts[1:]), data[:-3]):
        broken = records.shared_path(spark, "records-broken")
        os.makedirs(broken.removeprefix("file:"))
        with open(f"{broken.removeprefix('file:')}/{name}", "wb") as f:
            f.write(cut)
        with pytest.raises(Exception, match="missing|longer|cut off|checksum"):
            records.build_index(spark, broken).collect()


def test_files_of_an_empty_table(make_docs):
    _, index = records.encode_to_files(make_docs([]), PATH, end_id=2)
    assert index.count() == 0


def test_word_table_forgets_and_stays_right(tokenizer, lorem, monkeypatch):
    for limit in (records.CACHE_BYTES, 30_000, 0):
        monkeypatch.setattr(records, "CACHE_BYTES", limit)
        table = records.WordIds(tokenizer)
        for t in [lorem(15), "y" * 200 + " short", lorem(4000), lorem(3), "", lorem(2000)]:
            flat, bounds = table.encode([t.encode(), b"", b"two words"])
            got = [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            assert got == [expected(tokenizer, x) for x in (t, "", "two words")]
            assert len(table.runs[0][0]) + len(table.runs[1][0]) == table.parts


OTHER = public_tokenizers.path("byte_bpe_50k.json")


def test_tokenizers_that_do_not_keep_to_words_get_whole_texts(spark, make_docs, lorem):
    other = bpe.load(OTHER)
    assert bpe.splits_words(bpe.load(PATH)) and not bpe.splits_words(other)
    import random
    rng = random.Random(6)
    pairs = texts(lorem) + [(100 + i, "".join(rng.choice("aB \n\t'.,!<|>é1 ") for _ in range(rng.randint(0, 80)))) for i in range(200)]
    got = sorted(((r["doc_id"], list(r["ids"])) for r in bpe.encode(make_docs(pairs), OTHER).collect()), key=str)
    assert got == sorted(((d, expected(other, t)) for d, t in pairs), key=str)
    folder, _ = records.encode_to_files(make_docs(pairs), OTHER, end_id=50256)
    got = sorted(((r["doc_id"], list(r["ids"])) for r in records.read_records(spark, folder, ids=True).collect()), key=str)
    assert got == sorted(((d, expected(other, t) + [50256]) for d, t in pairs), key=str)


def test_the_vocabulary_stays_out_of_plans_and_of_the_driver(spark, tokenizer, monkeypatch):
    bpe.facts.cache_clear()
    with monkeypatch.context() as m:
        m.setattr("tokenizers.Tokenizer", None)       # tasks have a module of their own
        assert bpe.facts(PATH) == (True, False)
    rows = [(1, [5, 6, 700]), (2, []), (3, None), (4, [5, None, 10_000_000, -1, 6])]
    out = spark.createDataFrame(rows, "doc_id long, ids array<int>").select("doc_id", bpe.decode("ids", PATH).alias("text"))
    assert len(out._jdf.queryExecution().toString()) < 20_000
    assert dict(map(tuple, out.collect())) == {1: tokenizer.decode([5, 6, 700], skip_special_tokens=False), 2: "", 3: "",
                                               4: tokenizer.decode([5, 6], skip_special_tokens=False)}
