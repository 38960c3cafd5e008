"""Periodic runs against the plain definition."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHING, documents, words
from tickloom.llm import runs
from tickloom.llm.catalog import QUERIES


def plain_runs(line, least=runs.LEAST):
    """(begin, end, period) of all runs by comparing words each distance apart."""
    smallest = {}
    for q in range(1, len(line) // 2 + 1):
        i = 0
        while i + q < len(line):
            j = i
            while j + q < len(line) and line[j] == line[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                smallest.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e, q) for (s, e), q in smallest.items()), key=lambda r: (r[0], r[2]))


def repeating(rng, kind):
    """Words that repeat in many ways."""
    k = rng.choice([1, 2, 2, 3, 4])
    length = rng.randint(0, 150)
    if kind == "random":
        return rng.choices(range(k), k=length)
    if kind == "fibonacci":
        a, b = [0], [0, 1]
        while len(b) < length:
            a, b = b, b + a
        return b
    line = []
    while len(line) < length:
        if kind == "powers":
            root = rng.choices(range(k), k=rng.randint(1, 30))
            line += root * rng.randint(1, 6) + root[:rng.randint(0, len(root))]
        else:  # periodic stretches that touch or overlap
            stretch = rng.choices(range(2), k=rng.randint(1, 4)) * rng.randint(1, 12)
            line += stretch[rng.randint(0, len(stretch)):]
    return line * rng.randint(1, 3)


@pytest.mark.parametrize("kind", ["random", "fibonacci", "powers", "touching"])
def test_runs_equal_definition(kind):
    rng = random.Random(kind)
    for _ in range(300):
        line = repeating(rng, kind)
        line += [9, *line] if rng.random() < 0.3 else []
        found = runs.find_runs(np.array([*line, 99], np.int32), len(line))
        assert [tuple(map(int, r)) for r in found] == plain_runs(line), line


@pytest.mark.parametrize("size", [1, 2, 5, 64, 1000])
def test_wavelet_tree(size):
    rng = np.random.default_rng(size)
    values = rng.permutation(size)
    tree = runs.WaveletTree(values)
    left = rng.integers(0, size, 200)
    right = np.array([rng.integers(b + 1, size + 1) for b in left])
    bound = rng.integers(0, 2 * size + 2, 200)
    place = np.array([rng.integers(0, e - b) for b, e in zip(left, right)])
    assert tree.below(left, right, bound).tolist() == [
        int((values[b:e] < x).sum()) for b, e, x in zip(left, right, bound)]
    assert tree.nth(left, right, place).tolist() == [
        int(np.sort(values[b:e])[x]) for b, e, x in zip(left, right, place)]


def plain_query(doc_id, text):
    line = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and line:
        g = h // 10
        a = g % len(line)
        p = 1 + (len(line) - a) // (3 + g % 8)
        line = [w if i < a else line[a + (i - a) % p] for i, w in enumerate(line)]
    found = plain_runs(line)
    gone = {i for s, e, q in found for i in range(s + q, e)}
    best = min(found, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    figures = (None,) * 4 if best is None else (
        best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    kept = " ".join(w for i, w in enumerate(line) if i not in gone)
    return (doc_id, len(found), *figures, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest())


def test_query_against_definition(spark, tmp_path):
    rng = random.Random(2)
    texts = [None, "", " \n\t ", "é" * 3 + " x y" * 9, "  " * 14]
    for _ in range(60):
        vocabulary = words(rng, 3)
        line = repeating(rng, rng.choice(["random", "powers", "touching"]))
        texts.append("".join(vocabulary[w % 3] + rng.choice([" ", "\n", "  ", "\t"]) for w in line))
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == sorted(plain_query(i, t) for i, t in enumerate(texts))


def test_odd_rows(spark, odd_docs, no_docs):
    looped = odd_docs.withColumn("text", F.concat_ws(" ", "text", F.lit("again and " * 8)))
    found = runs.periodic_runs(looped)
    assert "_rest" in found.columns and found.count() == 9
    ends = [(r["doc_id"], [tuple(x) for x in r["runs"]]) for r in found.collect()]
    assert all(len(own) == 1 and own[0][1:] == (16, 2) for _, own in ends)
    assert runs.periodic_runs(odd_docs).where("size(runs) > 0").count() == 0
    assert runs.periodic_runs(no_docs).count() == 0
    assert set(CLASHING) <= set(odd_docs.columns)


def test_one_word_many_times():
    found = runs.find_runs(np.array([0] * 50_000 + [1], np.int32), 50_000)
    assert found.tolist() == [[0, 50_000, 1]]
