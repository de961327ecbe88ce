"""Token alignment against a version that meets one token at a time."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from strainframe.llm import alignment
from strainframe.llm.bpe import byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, chunk string, keys int, pair string"


def spelled(text: str, a_side: Tokenizer, b_side) -> tuple[list[tuple[int, bytes]], list[tuple[int, bytes]]]:
    letter = {c: i for i, c in enumerate(byte_letters())}
    piece = lambda i: bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode()
    a = [(i, bytes(letter[c] for c in a_side.id_to_token(i))) for i in a_side.encode(" " + text, add_special_tokens=False).ids]
    return a, [(i, piece(i)) for i in b_side.encode(text)]


def brute_force(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    a_side, b_side = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_side.encode_special_tokens = True
    found, counts = [], Counter()
    for key, text in rows:
        a, b = spelled(text, a_side, b_side) if text else ([], [])
        want = (" " + (text or "")).encode()
        if any(b"".join(t for _, t in side) != want for side in (a, b)):
            a = b = []
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, token in side:
                out.append((at, at + len(token), i))
                at += len(token)
            spans.append(out)
        links, first = [], 0
        for s, e, i in spans[0]:
            while spans[1][first][1] <= s:
                first += 1
            j = first
            while j < len(spans[1]) and spans[1][j][0] < e:
                links.append((i, spans[1][j][2]))
                j += 1
        groups, began = [], 0
        for end in sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]}):
            groups.append("|".join(",".join(str(i) for s, e, i in side if s >= began and e <= end) for side in spans) if len(want) < 3000 else "")
            began = end
        counts.update(links)
        found.append((key, len(a), len(b), groups, links, len(want) < 3000))
    most: dict[int, int] = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return [(key, n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), (hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") if short else None) for key, n_a, n_b, groups, links, short in found]


def test_alignment_against_brute_force(spark):
    rng = random.Random(1)
    odd = [None, "", " ", "  ", "a", "<|endoftext|> x", "<s> </s> <unk>", "x▁y", "a\0b", "tab\there\n\nnew  two   three ", "\xa0　wide", "漢字 😀😀", "'s don't I'LL", "\r\n x", "<0x41>", "é combining", "ﬁ ligature Ⅳ ①", "​ zero", "1234567890 12 3", "trailing ", "a  "]
    odd += ["".join(rng.choice(" \n\t ab'sé漢😀1., \xa0　") for _ in range(rng.randint(1, 40))) for _ in range(150)]
    rows = [*enumerate(odd), (None, "hello world"), (3, "rep"), (3, "rep"), (3, "rep"), (900, "aaaa" * 3000), (901, "the same word " * 2000)]
    df = spark.createDataFrame([(k, t, "x", 1, None) for k, t in rows], SCHEMA)
    got = [tuple(r) for r in alignment.aligned_digests(df, "doc_id", "text", A, B).collect()]
    want = brute_force(rows)
    place = lambda r: (str(r[0]), r[1:7])
    assert len(got) == len(want)
    for x, y in zip(sorted(got, key=place), sorted(want, key=place), strict=True):
        assert x[:7] == y[:7] and y[7] in (None, x[7])


def test_counts_meet_over_many_chunks(spark, monkeypatch):
    rows = [(i, f"word{i % 7} and again {'and ' * (i % 5)}") for i in range(60)]
    monkeypatch.setattr(alignment, "STEP", 200)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    # Workers import the module anew, so small chunks are made here, in this process.
    sides = alignment.tokenizers(A, B)
    from strainframe.llm.units import runs, text_bytes

    batch = df.toArrow().combine_chunks().to_batches()[0]
    assert len(runs(text_bytes(batch.column(1))[1], alignment.STEP)) > 5 and sides[1].cuts and sides[0].fast
    got = sorted(tuple(r) for r in alignment.aligned_digests(df, "doc_id", "text", A, B).collect())
    assert [x[:7] for x in got] == [y[:7] for y in brute_force(rows)] and [x[7] for x in got] == [y[7] for y in brute_force(rows)]


def test_groups_cover_each_text(spark):
    texts = {1: "unbelievably héllo, wörld", 2: "x▁y", 3: None, 4: "tail "}
    df = spark.createDataFrame([(k, t) for k, t in texts.items()], "key long, text string")
    rows = alignment.grouped(df, "key", "text", A, B).collect()
    assert {r.key for r in rows} == {1, 4}
    for key in (1, 4):
        own = sorted((r for r in rows if r.key == key), key=lambda r: r.group)
        assert [r.group for r in own] == list(range(len(own)))
        assert [own[0].first_byte, *(r.end_byte for r in own)] == [r.first_byte for r in own] + [len((" " + texts[key]).encode())]
        a, b = spelled(texts[key], Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B))
        assert [i for r in own for i in r.a_ids] == [i for i, _ in a] and [i for r in own for i in r.b_ids] == [i for i, _ in b]


def test_alignment_of_an_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert alignment.aligned_digests(none, "doc_id", "text", A, B).count() == 0 and alignment.grouped(none, "doc_id", "text", A, B).count() == 0
