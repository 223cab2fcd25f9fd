import random
import re

from conftest_llm import docs_frame
from scenaria.llm.fertility import base_counts, judge, pieces_of_characters, token_measures

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_counts(t):
    words = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    inside = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(inside)


def test_base_counts_against_plain_loops():
    rng = random.Random(8)
    for _ in range(300):
        words = rng.choices(["a", "b", "é#", "$%", "ünï\x1c", "x y", "longer"], k=rng.randint(0, 60))
        text = "".join(w + rng.choice([" ", "\n", "\t", "\x0b", "  ", "\r\n"]) for w in words)
        text = text * rng.choice([1, 1, 2, 3])
        assert base_counts(text) == slow_counts(text)
    for text in ("", " \n ", "w " * 7, "w " * 8, "w " * 9, "a b c d e f g h " * 2, "é" * 100_000):
        assert base_counts(text) == slow_counts(text)


def test_token_measures():
    assert token_measures("", "byte_bpe_50k.json") == (0, 0.0, 0.0, 1.0)
    n, chars, fallback, entropy = token_measures("the the the the", "byte_bpe_50k.json")
    assert n == 4 and chars == 15 / 4 and fallback == 0 and 0 < entropy < 1
    assert token_measures("ꙮ", "byte_bpe_50k.json")[2] == 1.0
    assert pieces_of_characters("byte_bpe_50k.json").sum() > 128


def test_verdicts(spark):
    rng = random.Random(9)
    words = ["time", "people", "water", "house", "small", "green", "walks", "reads", "under", "often", "letter", "window", "and", "of"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(25, 200))) + ".", "s") for i in range(300)]
    odd = [(1000, " ".join("ꙮ꙰%d" % i for i in range(250)), "s"), (1001, None, "s"), (1002, "", "s"), (1003, "few words", "s"),
           (1004, "a b c d e f g h i j " * 30, "s"), (None, rows[0][1], "s"), (5, rows[5][1], "s")]
    out = judge(docs_frame(spark, rows + odd, extra=True)).collect()
    assert len(out) == len(rows) + len(odd)
    got = {r.id: r for r in out}
    assert sum(got[i].kept for i, _, _ in rows) >= 298
    assert not got[1000].kept and not got[1000].base_failed
    assert all(got[i].base_failed and not got[i].kept for i in (1001, 1002, 1003, 1004)) and got[None].kept
    assert judge(docs_frame(spark, [])).count() == 0


def test_white_space_of_any_length():
    text = "a" + " " * 1_200_000 + "b" + "\n" * 1_500_000 + "c"
    for v in ("byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"):
        n, chars, _, _ = token_measures(text, v)
        assert n > 2 and chars == len(text) / n
