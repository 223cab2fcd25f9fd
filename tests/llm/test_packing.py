import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from conftest_llm import docs_frame
from scenaria.llm.packing import encode, encode_added, pack, pack_lengths, pieces, places


def test_patterns_fill_and_use_every_piece():
    rng = np.random.default_rng(1)
    for draw in (lambda: rng.integers(1, 1025, 3000), lambda: rng.integers(1, 40, 3000), lambda: np.full(50, 600)):
        lengths, counts = np.unique(draw(), return_counts=True)
        given = dict(zip(lengths.tolist(), counts.tolist(), strict=True))
        patterns = pack_lengths(given, 1024)
        used = {}
        for p, k in patterns:
            assert k > 0 and sum(p) <= 1024
            for n in p:
                used[n] = used.get(n, 0) + k
        assert used == given
        least = max(-(-int((lengths * counts).sum()) // 1024), int(counts[lengths > 512].sum()))
        assert sum(k for _, k in patterns) <= 1.03 * least + 1
        spans = {}
        for n, a, b, _, _ in places(patterns):
            spans.setdefault(n, []).append((a, b))
        for n, s in spans.items():
            s.sort()
            assert s[0][0] == 0 and s[-1][1] == given[n] and all(x[1] == y[0] for x, y in zip(s, s[1:], strict=False))


def test_pieces_and_sequences(spark):
    texts = ["", None, "one two", "héllo wörld " * 900, "x" * 20000, "tie tie", "tie tie"] + ["hot copy of a text"] * 600
    df = docs_frame(spark, [(i, t, "s") for i, t in enumerate(texts)] + [(2, "one two", "s"), (None, "no id", "s")], extra=True)
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    rows = pack(pieces(df, "doc_id", "text")).collect()
    want = {}
    for i, t in enumerate(texts):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4")
        got = sorted([r for r in rows if r.doc_id == i], key=lambda r: r.piece)
        if i == 2:
            assert len(got) == 2
            continue
        assert got[0].start == 0 and sum(r.length for r in got) == len(ids) and all(r.length == 1024 for r in got[1:])
        for r in got:
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
        want[i] = len(ids)
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 1024
    total = sum(r.length for r in rows)
    assert len(seqs) <= -(-total // 1024) + 1


def test_empty_table(spark):
    assert pack(pieces(docs_frame(spark, []), "doc_id", "text")).count() == 0


def test_white_space_of_any_length():
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    spaces = "\t\n\x0b\x0c\r \x85\xa0                　"
    texts = [" " * 1_200_000 + "a", "a" + "\n" * 1_500_000 + "b", " \n" * 600_000, "x \r\n" + spaces * 400 + "\n!" + "\t" * 5000]
    texts += [a + c * n + b for c in spaces + "\x1c​﻿" for n in (4095, 4096, 4097, 5001) for a in ("", "é's") for b in ("", "y", "\x1c9", "'s")]
    for t in texts:
        assert encode(t, "byte_bpe_50k.json") == tok.encode(t, add_special_tokens=False).ids, (t[:5], t[-5:], len(t))


def test_a_very_long_run_fails_no_task(spark):
    rows = [(1, "a" + " " * 1_100_000 + "b", "s"), (2, "\n" * 1_500_000 + "b", "s"), (3, "one", "s")]
    got = {r.doc_id: r.n for r in pieces(docs_frame(spark, rows), "doc_id", "text").groupBy("doc_id").agg({"length": "sum"})
           .withColumnRenamed("sum(length)", "n").collect()}
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert got == {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t, _ in rows}


def test_added_tokens_in_text(spark):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"end {end} start", end, f"{end}{end} {end}", f"a  {end}\n\n{end}  b", f"<|endoftext|{end}|>", "<|endoftext", end.upper(),
             f"it{end}'s", " " * 5000 + end + "\n" * 5000 + "x", f"é {end} ü " * 3000]
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(want[0]) == 4 and want[1] == [50256]
    assert [encode_added(t, "byte_bpe_50k.json") for t in texts] == want
    got = pieces(docs_frame(spark, [(i, t, "s") for i, t in enumerate(texts)]), "doc_id", "text").collect()
    for i, ids in enumerate(want):
        ids = np.array(ids + [2], dtype="<u4")
        mine = [r for r in got if r.doc_id == i]
        assert sum(r.length for r in mine) == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes()) for r in mine)
