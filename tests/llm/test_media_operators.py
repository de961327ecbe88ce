"""Tokens, media, archives and vectors against the libraries, round trips and brute force."""

import base64
import hashlib
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from strainframe.llm import ann, bpe, packing, queries, tiff, warc
from strainframe.llm.shared import stored

BYTE, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"
PIECES = ["a", "b", "T", "É", "é", "aaaa", "'", "'s", "'LL", "1", "22", "½", ",", "!!", "<|endoftext|>", "<|ENDOFTEXT|>", "—", "́", "İ", "中", "한", "😀", " ", " ", "\n", "\t", "\x0b", "\x1c", "\x00", "\x85", "\xa0", "　", "_", "Ω", "'ve", "the", "ing", "×"]


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return [None, "", " ", "\n\n", *("".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(n)), "the quick brown fox " * 3000]


def test_byte_bpe_equals_the_library(spark):
    texts = odd_texts(400)
    t = Tokenizer.from_file(BYTE)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    name = bpe.build_lexicon(df, "text", BYTE, size=200)
    for r in bpe.encode_decode(df, "doc_id", "text", BYTE, name).collect():
        want = t.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want
        assert bytes(r.decoded).decode("utf-8", "replace") == t.decode(want, skip_special_tokens=False)


def test_lexicon_is_minimal_and_exact(tmp_path):
    units = sorted({w.encode() for w in ("walking", "talking", "walked", "talked", "wal", "king", " walking")})
    path = str(tmp_path / "lexicon.bin")
    bpe.Lexicon.write(path, units, [np.array([i, i]) for i in range(len(units))])
    lexicon = bpe.Lexicon(path)
    asked = [*units, b"", b"walkin", b"walkings", b"x"]
    assert lexicon.ranks(pa.array(asked, pa.binary())).tolist() == [*range(len(units)), -1, -1, -1, -1]
    # Seven words end in one of "ing" and "ed"; shared suffixes leave fewer arcs than a trie of the words.
    assert lexicon.arcs < len({u[:i] for u in units for i in range(1, len(u) + 1)})


def test_word_tokenizer_equals_the_library():
    words, t = packing.WordTokenizer(WORDS), packing.tokenizer_at(WORDS)
    texts = odd_texts(800, seed=2)
    ids, at = words(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("fan_in", [2, 64])
def test_packing(spark, fan_in):
    texts = odd_texts(150, seed=3)
    t = packing.tokenizer_at(WORDS)
    rows = [(i, x, "c", 1) for i, x in enumerate(texts)]
    df = spark.createDataFrame([*rows, (None, "null id", None, None)], "doc_id long, text string, chunk string, length int").repartition(5)
    got = packing.pack(df, "doc_id", "text", WORDS, end_id=2, capacity=64, open_windows=3, fan_in=fan_in).collect()
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for i, x in enumerate(texts):
        ids, at = [*t.encode(x or "", add_special_tokens=False).ids, 2], 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    sizes = []
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        sizes.append(at)
    assert max(sizes) <= 64 and sum(s < 64 for s in sizes) <= 1


def raw_pages():
    rng = np.random.default_rng(1)
    return [rng.integers(0, 256, (70, 100)).astype(np.uint8), np.zeros((1, 1), np.uint8), np.repeat(rng.integers(0, 3, (33, 10)), 13, axis=1).astype(np.uint8)]


@pytest.mark.parametrize("compression", [tiff.NONE, tiff.PACKBITS, tiff.LZW, tiff.DEFLATE])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("tile", [0, 16])
def test_tiff_round_trip(compression, predictor, tile):
    pages = raw_pages()
    got = list(tiff.pages_of(tiff.write_tiff(pages, compression, predictor, rows_per_strip=20, tile=tile)))
    assert [g[0] for g in got] == [0, 1, 2] and all(g[-1] is None for g in got)
    for page, g in zip(pages, got):
        assert g[1:3] == (page.shape[1], page.shape[0]) and g[7] == page.tobytes()


def test_lzw_over_full_tables():
    data = np.random.default_rng(2).integers(0, 256, 30_000).astype(np.uint8).tobytes()
    assert tiff.lzw_decode(tiff.lzw_encode(data)) == data
    assert tiff.lzw_decode(tiff.lzw_encode(b"")) == b""


def test_tiff_big_endian_and_damage():
    # One strip of two by one samples, written by hand in the other byte order.
    tags = [(256, 3, 1, 2 << 16), (257, 3, 1, 1 << 16), (258, 3, 1, 8 << 16), (259, 3, 1, 1 << 16), (273, 4, 1, 8), (279, 4, 1, 2)]
    data = b"MM\0*" + struct.pack(">I", 10) + b"hi" + struct.pack(">H", len(tags)) + b"".join(struct.pack(">HHII", *t) for t in tags) + struct.pack(">I", 0)
    assert list(tiff.pages_of(data)) == [(0, 2, 1, 1, 1, 1, False, b"hi", None)]
    loop = data[:-4] + struct.pack(">I", 10)
    assert [r[0] for r in tiff.pages_of(loop)] == [0, -1]
    for bad in (None, b"", b"not a file", data[:12]):
        (row,) = tiff.pages_of(bad)
        assert row[0] == -1 and row[-1]
    whole = tiff.write_tiff(raw_pages(), tiff.DEFLATE)
    broken = whole[:8] + b"\0\0\0" + whole[11:]
    assert list(tiff.pages_of(broken))[0][-1] and list(tiff.pages_of(broken))[1][-1] is None


def test_text_media(spark):
    texts = [None, "", "x" * 191, "é" * 500, "line\n" * 30_000]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)] + [(None, "null id", 1), (1, "", 1)], "doc_id long, text string, page int")
    media = tiff.encode_text_media(df, "doc_id", "text")
    rows = {r.doc_id: r for r in tiff.media_digest(media, "doc_id", "media", keep=["n_bytes"]).collect()}
    for i, t in enumerate(texts):
        assert rows[i].n_bytes == len((t or "").encode()) and rows[i].payload_bytes % 192 == 0
    pages = tiff.decode_pages(media, "doc_id", "media").where("doc_id = 4").orderBy("page").collect()
    assert len(pages) == -(-150_000 // (192 * 256)) and b"".join(bytes(p.pixels) for p in pages).rstrip(b" ").decode() == texts[4]


def test_warc_round_trip(spark):
    rng = random.Random(1)
    bodies = ["", None, "a", "é" * 9000, "".join(rng.choice("abc\r\n") for _ in range(50_000)), "a", "é" * 9000, "0\r\n\r\n"]
    rows = [(i, f"http://x/{i} y", b, "z") for i, b in enumerate(bodies)] + [(None, None, "a", None), (2, "http://x", "a", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload string").repartition(3)
    got = warc.archived(df, "page_id", "url", "html", segment_bytes=1000, chunk_bytes=300, archive_bytes=5000).collect()
    assert len(got) == len(rows) and all(r.error is None for r in got)
    first = {}
    for i, b in enumerate(bodies):
        first.setdefault(b or "", i)
    for r in got:
        name = r.record_id.split(":")[2]
        if name:
            i = int(name)
            body = (bodies[i] or "").encode()
            assert r.payload_digest == warc.digest32(body)
            assert r.record_type == ("response" if first[bodies[i] or ""] == i else "revisit")
            if r.record_type == "response":
                assert bytes(r.payload) == body and r.segments == max(1, -(-len(warc.HTTP_HEAD + warc.chunked(body, 300)) // 1000))
            else:
                assert int(r.refers_to.split(":")[2]) == first[bodies[i] or ""]


def test_warc_damage(spark):
    df = spark.createDataFrame([(1, "u", "x" * 5000)], "page_id long, url string, html string")
    marked = warc.with_originals(df, "page_id", "html")
    from pyspark.sql import functions as F

    rows = marked.select(F.col("page_id").alias("name"), F.col("url").alias("target"), F.encode("html", "UTF-8").alias("payload"), "refers_to")
    records = warc.read_records(stored(warc.archives(rows, segment_bytes=1000), "archives"))
    assert warc.reassembled(records).first().error is None
    for lost in (1, 3, 6):
        (r,) = warc.reassembled(records.where(f"segment != {lost}")).collect()
        assert r.payload is None and r.error
    (r,) = warc.reassembled(records.unionByName(records.where("segment = 2"))).collect()
    assert r.error
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_nearest_vectors(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(300, 16)), 3).astype(np.float32)
    x[40:60] = x[0]
    x[61] = 0
    rows = [(i, [float(v) for v in x[i]], "b") for i in range(300)]
    rows += [(900, None, "b"), (901, [None] * 16, "b"), (902, [float("nan")] * 16, "b"), (903, [float("inf")] + [0.0] * 15, "b"), (904, [], "b"), (None, rows[5][1], "b"), (950, [1.0, 2.0], "b"), (rows[70][0], rows[70][1], "b")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, block string").repartition(4)
    got = ann.nearest(df, "vec_id", "embedding", every=50, k=5, query_block=2, candidate_block=64).collect()
    ids = np.array([r[0] for r in rows if r[0] is not None and r[0] < 900 and r[0] != 61])
    u = np.array([r[1] for r in rows if r[0] is not None and r[0] < 900 and r[0] != 61])
    u = u / np.linalg.norm(u, axis=1, keepdims=True)
    for q in range(0, 300, 50):
        score = u @ u[list(ids).index(q)]
        score = np.where(ids == q, -9, np.round(score, 12))
        order = np.lexsort((ids, -score))[:5]
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.vec_id for r in own] == ids[order].tolist()
        assert np.allclose([r.score for r in own], score[order], atol=1e-11)
    assert not [r for r in got if r.query_id in (900, 950)]


def test_error_bounds_hold():
    rng = np.random.default_rng(4)
    # More than 1,040 components of the largest code: float32 sums alone would not be exact.
    for x in (rng.normal(size=(200, 24)) * 10.0 ** rng.integers(-3, 4, (200, 1)), rng.choice([-1.0, 1.0], (40, 3001))):
        block = ann.Block.coded(np.arange(len(x)), x)
        exact = block.codes.astype(np.int64) @ block.codes.astype(np.int64).T
        assert (ann.products(block.codes, block.codes) == exact).all()
        near = exact * block.scales[:, None] * block.scales[None, :]
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        e = block.errors
        assert (np.abs(near - unit @ unit.T) <= e[:, None] + e[None, :] + e[:, None] * e[None, :] + 1e-9).all()


def test_a_vector_that_most_rows_share(spark):
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 else [float(i), 1.0, -1.0]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = ann.nearest(df, "vec_id", "embedding", every=50, k=5, query_block=4, candidate_block=16).collect()
    for q in (50, 100, 200):
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)] == [i for i in range(400) if i % 3 and i != q][:5]


def nearest_by_hand(table, every, k):
    rows = {}
    for key, v in zip(table["vec_id"].to_pylist(), table["embedding"].to_pylist()):
        if key is not None and v and None not in v and np.isfinite(v).all() and any(v):
            rows[key] = np.array(v, np.float64)
    ids = np.array(sorted(rows))
    u = np.stack([rows[i] / np.linalg.norm(rows[i]) for i in ids])
    for q in ids[ids % every == 0]:
        score = u @ u[list(ids).index(q)]
        score[ids == q] = -9
        order = np.lexsort((ids, -np.round(score, 12)))[:k]
        yield from ((int(q), r + 1, int(ids[i]), score[i]) for r, i in enumerate(order))


def test_nearest_query_on_its_table(spark):
    want = list(nearest_by_hand(pq.read_table(f"{SF}/embeddings.parquet"), 50, 5))
    got = {(r.query_id, r["rank"]): r for r in queries.op4_block_matrix_join(spark, SF).collect()}
    assert len(got) == len(want)
    for q, rank, v, score in want:
        assert got[q, rank].vec_id == v and abs(got[q, rank].score - score) < 1e-12


def test_tiff_query_on_its_table(spark):
    rows = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = {r.doc_id: r for r in queries.op1_tiff_pages(spark, SF).collect()}
    forms = set()
    for r in rows:
        raw = (r["text"] or "").encode()
        size = max(1, -(-len(raw) // 192)) * 192
        payload = raw.ljust(size)
        g = got[r["doc_id"]]
        media = tiff.text_media(raw, 256)
        forms.add(zlib.crc32(raw) % 16)
        assert (g.n_bytes, g.payload_bytes, g.payload_sha256, g.tail_crc32) == (len(raw), size, hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert (g.media_bytes, g.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
        values = np.frombuffer(payload, np.uint8).astype(float)
        pages, mean, spread, kinds = g.feature.split("/")
        assert int(pages) == -(-size // (192 * 256)) and int(kinds) == len(set(payload))
        assert abs(float(mean) - values.mean()) < 1e-5 and abs(float(spread) - values.std()) < 1e-5
    assert {0, 1, 2, 3, 4} <= forms


def test_media_digest_of_odd_files(spark):
    good = tiff.write_tiff(raw_pages())
    loop = bytearray(good)
    last = struct.unpack_from("<I", good, 4)[0]
    while True:
        (count,) = struct.unpack_from("<H", good, last)
        link = last + 2 + 12 * count
        (after,) = struct.unpack_from("<I", good, link)
        if not after:
            break
        last = after
    struct.pack_into("<I", loop, link, struct.unpack_from("<I", good, 4)[0])
    rows = [(1, good), (1, good), (2, None), (3, b"no"), (4, bytes(loop)), (4, bytes(loop)), (None, good)]
    df = spark.createDataFrame(rows, "doc_id long, media binary").coalesce(1)
    got = tiff.media_digest(df, "doc_id", "media", keep=[]).collect()
    assert sorted((str(r.doc_id), r.payload_bytes) for r in got if r.payload_bytes) == [("1", 7000 + 1 + 33 * 130)] * 2 + [("None", 7000 + 1 + 33 * 130)]
    assert sorted(r.doc_id for r in got if r.payload_bytes is None) == [2, 3, 4, 4]


def one_page(order, bits, samples, height, width, strips, predictor=1, planes=1, fill=1, compression=1):
    """A file of one page from ready strips, in either byte order."""
    out, spots = bytearray((b"II*\0" if order == "<" else b"MM\0*") + b"\0\0\0\0"), []
    for x in strips:
        spots.append(len(out))
        out += x + b"\0" * (len(x) % 2)
    arrays = []
    for values in (spots, [len(x) for x in strips], [bits] * samples):
        arrays.append(len(out))
        out += struct.pack(f"{order}{len(values)}I", *values)
    place = lambda values, at: values[0] if len(values) == 1 else at
    tags = [(256, width, 1), (257, height, 1), (258, place([bits] * samples, arrays[2]), samples), (259, compression, 1), (266, fill, 1), (273, place(spots, arrays[0]), len(spots)), (277, samples, 1), (278, height, 1), (279, place([len(x) for x in strips], arrays[1]), len(strips)), (284, planes, 1), (317, predictor, 1)]
    struct.pack_into(order + "I", out, 4, len(out))
    out += struct.pack(order + "H", len(tags))
    for tag, value, n in tags:
        out += struct.pack(order + "HHII", tag, 4, n, value)
    return bytes(out + b"\0\0\0\0")


@pytest.mark.parametrize("order", ["<", ">"])
def test_tiff_depths_planes_and_bit_order(order):
    rng = np.random.default_rng(5)
    wide = rng.integers(0, 65536, (5, 7, 3)).astype("u2")
    own = wide.astype(order + "u2")
    plain = one_page(order, 16, 3, 5, 7, [own.tobytes()])
    differences = wide.copy()
    differences[:, 1:] -= wide[:, :-1]
    differenced = one_page(order, 16, 3, 5, 7, [differences.astype(order + "u2").tobytes()], predictor=2)
    planar = one_page(order, 16, 3, 5, 7, [own[:, :, i].tobytes() for i in range(3)], planes=2)
    for data in (plain, differenced, planar):
        assert [p[7] for p in tiff.pages_of(data)] == [wide.astype("<u2").tobytes()]
    bits = rng.integers(0, 2, (4, 11)).astype(np.uint8)
    packed = np.packbits(bits, axis=1)
    assert next(tiff.pages_of(one_page(order, 1, 1, 4, 11, [packed.tobytes()])))[7] == bits.tobytes()
    mirrored = np.packbits(np.unpackbits(packed, axis=1).reshape(4, -1, 8)[:, :, ::-1].reshape(4, -1), axis=1)
    assert next(tiff.pages_of(one_page(order, 1, 1, 4, 11, [mirrored.tobytes()], fill=2)))[7] == bits.tobytes()
    # Floating-point differencing: bytes of equal rank together, highest first, then differenced.
    real = rng.normal(size=(3, 6)).astype("<f4")
    ranks = real.view(np.uint8).reshape(3, 6, 4)[:, :, ::-1].transpose(0, 2, 1).reshape(3, 24)
    coded = ranks.copy()
    coded[:, 1:] -= ranks[:, :-1]
    assert next(tiff.pages_of(one_page(order, 32, 1, 3, 6, [coded.tobytes()], predictor=3)))[7] == real.tobytes()


def test_warc_query_with_awkward_rows(spark, tmp_path):
    folder = f"file://{tmp_path}"
    bodies = ["", "x", "x", None, "y" * 40_000, "x", "y" * 40_000, "é"]
    rows = [(i, f"u{i}", b, None, "o") for i, b in enumerate(bodies)] + [(None, None, "x", None, "o"), (2, "again", "x", None, "o"), (None, None, "alone", None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string, refers_to string, row string").repartition(3).write.parquet(f"{folder}/pages.parquet")
    got = [tuple(r) for r in queries.op5_warc_segments(spark, folder).collect()]
    first = {}
    for i, b in enumerate(bodies):
        first.setdefault(b or "", i)
    want = []
    for key, _, body, *_ in rows:
        raw = (body or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        revisit = key is not None and first[body or ""] < key
        want.append((key, len(raw), digest, "revisit" if revisit else "response", first[body or ""] if revisit else None))
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_warc_query_on_its_table(spark):
    rows = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    first = {}
    for r in sorted(rows, key=lambda r: r["page_id"]):
        first.setdefault(r["html"] or "", r["page_id"])
    got = {r.page_id: tuple(r) for r in queries.op5_warc_segments(spark, SF).collect()}
    for r in rows:
        raw = (r["html"] or "").encode()
        head = first[r["html"] or ""]
        assert got[r["page_id"]] == (r["page_id"], len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), *(("response", None) if head == r["page_id"] else ("revisit", head)))


def test_bpe_query_equals_the_library(spark):
    t = Tokenizer.from_file(BYTE)
    t.no_truncation()
    t.no_padding()
    got = {r.doc_id: r for r in queries.op9_bpe_lexicon(spark, SF).collect()}
    for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids
        g = got[r["doc_id"]]
        assert (g.n_tokens, g.ids_sha256, g.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_frequent_units_are_the_largest(spark):
    counts = [(bytes([i]), n) for i, n in enumerate([5, 3000, 3, 3, 1_000_000, 2, 3, 1500])]
    df = spark.createDataFrame(counts, "unit binary, n long")
    for size in range(1, 9):
        got = {n for u, n in counts if u in set(bpe.frequent_units(df, size))}
        assert len(bpe.frequent_units(df, size)) == size
        assert min(got) == sorted((n for _, n in counts), reverse=True)[size - 1]
    assert bpe.frequent_units(df.where("n < 0"), 5) == []


def test_packing_null_ids_of_equal_length(spark):
    df = spark.createDataFrame([(None, "same words here"), (None, "same words here"), (5, "same words here"), (None, None)], "doc_id long, text string").repartition(4)
    got = packing.pack(df, "doc_id", "text", WORDS, end_id=2, capacity=64).collect()
    assert sorted(str(r.doc_id) for r in got) == ["5", "None", "None", "None"]
    assert len({r.sequence_id for r in got}) == 1


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tiff.media_digest(tiff.encode_text_media(docs, "doc_id", "text"), "doc_id", "media", keep=["n_bytes"]).count() == 0
    assert bpe.encode_decode(docs, "doc_id", "text", BYTE, bpe.build_lexicon(docs, "text", BYTE)).count() == 0
    assert warc.archived(spark.createDataFrame([], "page_id long, url string, html string"), "page_id", "url", "html").count() == 0
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), "vec_id", "embedding", 50, 5).count() == 0
