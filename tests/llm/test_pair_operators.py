"""Operators on pairs, vectors and labels, and the pipeline."""

import collections
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_DIR
from tests.llm.conftest import documents, words
from tickloom.llm import ann, components, neardup, passages, text, toxicity
from tickloom.llm.catalog import ORACLES, QUERIES
from tickloom.session import CLEANUP


# Components -------------------------------------------------------------------------------------

def classes_of(links, vertices):
    top = {v: v for v in vertices}

    def find(v):
        while top[v] != v:
            v = top[v]
        return v
    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {v: find(v) for v in vertices}


@pytest.mark.parametrize("links", [
    [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(5, 5)], [(9, 1), (1, 9), (3, 4), (4, 8), (8, 9)]])
def test_components(spark, links):
    found = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long")).collect()))
    vertices = {v for link in links if link[0] != link[1] for v in link}
    assert found == classes_of([x for x in links if x[0] != x[1]], vertices)


# Near-duplicates --------------------------------------------------------------------------------

def cells(t):
    own = (t or "").encode().lower().split()
    counts = collections.Counter(tuple(own[i:i + 5]) for i in range(max(1, len(own) - 4)))
    return {(s, i) for s, n in counts.items() for i in range(n)}


def edited(rng, own, edits):
    out = list(own)
    for _ in range(edits):
        out[rng.randrange(len(out))] = "".join(rng.choices("xyz", k=6))
    return out


def test_no_link_is_lost_in_a_large_group(spark):
    """Copies with none to six edits of one text: links are thin, and most pairs are none."""
    rng = random.Random(11)
    base = words(rng, 150)
    texts = [" ".join(edited(rng, base, rng.choice([1, 2, 2, 3, 4, 6]))) for _ in range(90)]
    texts += [" ".join(words(rng, rng.choice([3, 40, 200]))) for _ in range(30)] + [texts[0], texts[0].upper()]
    sets = [cells(t) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i)
             if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    found = neardup.near_duplicates(documents(spark, texts)).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == classes_of(links, range(len(texts)))


def test_darts_agree_like_weighted_jaccard():
    rng = np.random.default_rng(1)
    elements = rng.integers(0, 2 ** 63, 400).astype(np.uint64)
    one = neardup.weighted_cells(np.concatenate([elements[:300], elements[:100]]))
    two = neardup.weighted_cells(np.concatenate([elements[50:400], elements[50:100], elements[50:100]]))
    true = len(np.intersect1d(one, two)) / len(np.union1d(one, two))
    agree = (neardup.dart_signature(one, 4096) == neardup.dart_signature(two, 4096)).mean()
    assert abs(agree - true) < 0.035
    small = neardup.weighted_cells(elements[:2])
    assert (neardup.dart_signature(small) == neardup.dart_signature(small.copy())).all()


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    found = neardup.near_duplicates(odd_docs).collect()
    assert len(found) == odd_docs.count()
    assert len({r["class_tie"] for r in found if r["doc_id"] in (1, 2)}) == 1  # no words at all
    kept = neardup.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.where("doc_id = 4").count() == 1
    assert neardup.near_duplicates(no_docs).count() == 0


# Passages ---------------------------------------------------------------------------------------

def plain_windows(hashes, span):
    out, todo = [], [(0, len(hashes) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a + 1 >= span:
            c = a + int(np.argmin(hashes[a:b + 1]))
            out.append((c, a, b))
            todo += [(a, c - 1), (c + 1, b)]
    return sorted(out)


def test_compact_windows_equal_the_cartesian_tree():
    rng = np.random.default_rng(2)
    for trial in range(60):
        rows = [rng.integers(0, 40 if trial % 2 else 2 ** 39, rng.integers(0, 60)).astype(np.uint64) << np.uint64(24)
                for _ in range(rng.integers(1, 6))]
        starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
        text_, c, left, right = passages.compact_windows(np.concatenate(rows), starts, 7)
        for i, row in enumerate(rows):
            own = text_ == i
            assert sorted(zip(c[own], left[own], right[own])) == plain_windows(row, 7)


def test_repeated_passages_are_found_and_others_left(spark):
    rng = random.Random(21)
    shared, near = words(rng, 55), words(rng, 140)
    texts = []
    for i in range(60):
        own = words(rng, rng.randint(60, 200))
        at = rng.randrange(len(own))
        if i < 20:
            own[at:at] = shared
        elif i < 25:
            copy = list(near)
            copy[10 + 20 * (i - 20)] = "other"
            own[at:at] = copy
        elif i < 40:
            own[at:at] = shared[:40]  # too short
        texts.append(" ".join(own))
    texts += [texts[50], None, "", "few words"]
    found = passages.repeated_passages(documents(spark, texts)).collect()
    spans = collections.defaultdict(list)
    for r in found:
        spans[r["doc_id"]].append(texts[r["doc_id"]].split()[r["start_word"]:r["end_word"]])
    assert set(spans) == {*range(25), 50, 60}
    assert all(any(" ".join(shared) in " ".join(s) for s in spans[i]) for i in range(20))


def plain_stretches(same, span):
    """Positions inside any stretch of ``span`` or more that begins and ends alike and is similar enough."""
    inside = set()
    for x in range(len(same)):
        for y in range(x + span, len(same) + 1):
            m, n = sum(same[x:y]), y - x
            if same[x] and same[y - 1] and 10 * m >= 8 * (2 * n - m):
                inside.update(range(x, y))
    return inside


def test_stretches_equal_brute_force():
    rng = random.Random(8)
    for _ in range(150):
        n, far = rng.randint(0, 70), rng.choice([0.02, 0.1, 0.2])
        same = [rng.random() > far for _ in range(n)]
        found = passages.stretches(np.zeros(n), 1 - np.array(same, float), 12)
        assert {i for x, y in found for i in range(x, y + 1)} == plain_stretches(same, 12)
    for size in range(50, 91, 10):
        for edit in range(size):
            shingles = np.arange(size - 4)
            other = np.where((shingles > edit - 5) & (shingles <= edit), -1, shingles)
            inside = plain_stretches((shingles == other).tolist(), 46)
            found = passages.stretches(shingles, other, 46)
            assert {i for x, y in found for i in range(x, y + 1)} == inside
            if 5 <= edit < size - 5:  # the whole passage but for the edges
                assert found == [(0, size - 5)]


def test_short_passages_with_one_edit_are_found(spark):
    rng = random.Random(33)
    texts, where = [], []
    for size in (60, 70, 80, 90):
        for edit in range(5, size - 5, 5):
            one = words(rng, size)
            two = one[:edit] + ["other"] + one[edit + 1:]
            for copy in (one, two):
                texts.append(" ".join(words(rng, 30) + copy + words(rng, 30)))
                where.append((30, 30 + size))
    found = passages.repeated_passages(documents(spark, texts)).collect()
    assert {r["doc_id"]: (r["start_word"], r["end_word"]) for r in found} == dict(enumerate(where))


def test_passages_are_found_where_other_texts_hold_parts_of_them(spark):
    """Texts that come first in their min-hash groups and hold 20 to 45 words of a shared passage."""
    rng = random.Random(44)
    shared = [words(rng, 70) for _ in range(8)]
    texts, holds = [], set()
    for i in range(240):
        own, passage = words(rng, 120), shared[i % 8]
        at = rng.randrange(len(own))
        if i % 3 == 0:
            holds.add(i)
            own[at:at] = passage
        else:
            begin, size = rng.randrange(25), rng.randint(20, 45)
            own[at:at] = passage[begin:begin + size]
        texts.append(" ".join(own))
    found = {r["doc_id"] for r in passages.repeated_passages(documents(spark, texts)).collect()}
    assert len(found & holds) >= 0.97 * len(holds)
    assert not found - holds


def test_passages_with_a_word_put_in_are_found(spark):
    rng = random.Random(45)
    texts = []
    for i in range(100):
        one = words(rng, 90)
        two = one[:45] + ["more"] + one[45:] if i % 2 else one[:44] + one[45:]
        texts += [" ".join(words(rng, 40) + copy + words(rng, 40)) for copy in (one, two)]
    found = collections.defaultdict(list)
    for r in passages.repeated_passages(documents(spark, texts)).collect():
        found[r["doc_id"]].append(r["end_word"] - r["start_word"])
    assert len(found) >= 180 and all(85 <= max(own) <= 95 for own in found.values())


def similarity(one, other):
    """Jaccard similarity of the shingle sets of two passages."""
    a, b = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (one, other))
    return len(a & b) / len(a | b)


def test_query_against_all_pairs(spark, tmp_path):
    """Pairs of 50-word stretches that begin and end alike and are similar enough are covered, and no other text is named."""
    rng = random.Random(46)
    pool = [words(rng, n) for n in (52, 60, 75, 110)]
    texts = []
    for i in range(40):
        own, copy = words(rng, rng.randint(30, 80)), list(rng.choice(pool))
        if rng.random() < 0.4:
            copy[rng.randrange(len(copy))] = "changed"
        if rng.random() < 0.6:
            own[rng.randrange(len(own)):0] = copy
        texts.append(own)
    documents(spark, [" ".join(t) for t in texts]).write.parquet(str(tmp_path / "documents.parquet"))
    rows = QUERIES["op4_substring_dedup"](spark, str(tmp_path)).collect()
    covered = collections.defaultdict(set)
    for r in rows:
        covered[r["doc_id"]].update(range(r["start_word"], r["end_word"]))
        one = texts[r["doc_id"]][r["start_word"]:r["end_word"]]
        assert len(one) >= 50
    wanted = collections.defaultdict(set)
    for i, one in enumerate(texts):
        for j, other in enumerate(texts):
            for shift in range(-len(one), len(other)) if i != j else ():
                low, high = max(0, -shift), min(len(one), len(other) - shift)
                for x in range(low, high - 49):
                    here, there = one[x:x + 50], other[x + shift:x + shift + 50]
                    if here[:5] == there[:5] and here[-5:] == there[-5:] and similarity(here, there) >= 0.8:
                        wanted[i].update(range(x, x + 50))
    total = sum(map(len, wanted.values()))
    assert total > 500 and sum(len(wanted[i] & covered[i]) for i in wanted) >= 0.9 * total
    assert sum(1 for i in wanted if covered[i]) >= 0.95 * len(wanted)
    assert set(covered) <= set(wanted)


def test_passages_of_odd_rows(odd_docs, no_docs):
    assert passages.repeated_passages(odd_docs).count() == 0
    assert passages.repeated_passages(no_docs).count() == 0
    twice = odd_docs.where("doc_id = 3").union(odd_docs.where("doc_id = 3"))
    assert [(r["start_word"], r["end_word"]) for r in passages.repeated_passages(twice).collect()] == [(0, 20_000)] * 2


# Toxicity ---------------------------------------------------------------------------------------

BAD = [f"{stem}{end}" for stem in ("vroz", "quill") for end in ("a", "ek", "umi", "oro", "ins", "at")]


def labelled(spark, seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        own = words(rng, rng.randint(20, 120))
        poor, toxic = rng.random() < 0.3, rng.random() < 0.2
        if poor:
            own += rng.choices(["###", "lorem"], k=3)
        if toxic:
            own += rng.sample(BAD, 3)
        rng.shuffle(own)
        rows.append((i, " ".join(own), "en", "s", 0, int(not poor), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, quality int, toxic int")
    return df.drop("quality", "toxic"), df.select("doc_id", "quality", "toxic")


def test_both_links_of_the_chain_work_on_unseen_rows_of_the_given_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    models = toxicity.train(docs, labels.where("doc_id % 2 = 0"), toxicity.CATEGORIES)
    scored = toxicity.score(docs, models, ["poor", "toxic"]).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    for found, truth, least in (("p_poor", lambda r: r["quality"] == 0, 0.8), ("p_toxic", lambda r: r["toxic"] == 1, 0.5)):
        hit = [r for r in scored if r[found] >= 0.5]
        assert sum(map(truth, hit)) >= least * sum(map(truth, scored))
        assert sum(map(truth, hit)) >= 0.95 * len(hit)


def test_figures_of_texts():
    given = pa.array(["Ab 12, ab\n", "", "\u00e9\u00e9"], pa.large_string())
    found = toxicity.figures(given, toxicity.Words(given))
    assert found.shape == (3, toxicity.FIGURES) and np.isfinite(found).all()
    assert np.allclose(found[0], [np.log1p(3) / 5, 2 / 3, 10 / 3 / 10, 0.2, 0.1, 0.1, 0, 2.0, 4 / 9, np.sqrt(0.2), np.sqrt(0.1)])
    assert found[2][6] == 1.0 and not found[1].any()
    assert np.allclose(toxicity.figures(given[1:], toxicity.Words(given[1:])), found[1:])


def test_chain_is_right_on_unseen_documents(spark):
    docs, labels = labelled(spark, 1, 900)
    models = toxicity.train(docs, labels, toxicity.CATEGORIES)
    assert len(models[1]["earlier"]) == toxicity.FIGURES + 1
    unseen, truth = labelled(spark, 2, 300)
    scored = toxicity.score(unseen, models, list(toxicity.CATEGORIES)).join(truth, "doc_id").collect()
    assert np.mean([(r["p_toxic"] >= 0.5) == (r["toxic"] == 1) for r in scored]) > 0.97
    assert np.mean([(r["p_poor"] >= 0.5) == (r["quality"] == 0) for r in scored]) > 0.9


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    _, labels = labelled(spark, 1, 6)
    odd = labels.union(spark.createDataFrame([(None, 1, 1), (3, None, None), (3, 0, 1)], labels.schema))
    found = toxicity.classify(odd_docs, odd)
    assert found.count() == odd_docs.count()
    assert text.restored(found, odd_docs).columns == odd_docs.columns
    assert toxicity.classify(no_docs, labels).count() == 0
    assert toxicity.classify(odd_docs, labels.limit(0)).where("_rejected").count() == 0


# Nearest neighbours -----------------------------------------------------------------------------

def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int")


def test_exact_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF", 16)
    rng = np.random.default_rng(5)
    points = (rng.normal(size=(600, 5)) * rng.uniform(0.1, 4, (600, 1))).astype(np.float32)
    points[7] = points[3]
    points[100:110] = points[40]  # ties
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    odd = [(1000, None), (1020, [0.0] * 5), (1040, [1.0, None, 0.0, 0.0, 0.0]), (1001, [float("nan")] * 5),
           (1060, [float("inf")] * 5), (1002, [9.0, 9.0]), (1003, [])]
    monkeypatch.setattr(ann, "SHARD_ROWS", 150)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 9)
    found = collections.defaultdict(list)
    for r in ann.nearest(vectors(spark, rows + odd), relax=1.0).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    wide = points.astype(np.float64)
    assert sorted(found) == list(range(0, 600, 20))
    for q, own in found.items():
        scores = wide @ wide[q]
        scores[q] = -np.inf
        want = sorted(range(600), key=lambda i: (-scores[i], i))[:20]
        assert np.allclose([s for _, s in own], scores[want], atol=1e-12)
        assert {v for v, s in own if s > scores[want[-1]] + 1e-9} == {i for i in want if scores[i] > scores[want[-1]] + 1e-9}


@pytest.mark.parametrize("relax", [1.0, 4.0])
def test_of_equal_vectors_the_smallest_ids_stay(spark, relax):
    rng = np.random.default_rng(9)
    points = rng.normal(size=(3000, 6)).astype(np.float32)
    same = rng.permutation(3000)[:100]
    points[same] = np.float32(3.1) * np.ones(6, np.float32)
    swaps = [i for i in range(3000) if i not in set(same.tolist())][:60]
    points[swaps] = np.float32(0.0)
    points[swaps, np.arange(60) % 6] = np.float32(7.0)  # other vectors, same product with those of one value
    found = collections.defaultdict(list)
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    for r in ann.nearest(vectors(spark, rows), relax=relax).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["vec_id"])
    near = 0
    for q, own in found.items():
        scores = points.astype(np.float64) @ points[q].astype(np.float64)
        want = [i for i in sorted(range(3000), key=lambda i: (-round(scores[i], 9), i)) if i != q][:20]
        if relax == 1.0 or set(want) <= set(same.tolist()):
            assert own == want
            near += set(want) <= set(same.tolist())
    assert near >= 3


def test_few_and_no_vectors(spark):
    assert ann.nearest(vectors(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [0.0, 0.0])])).count() == 1
    assert ann.nearest(vectors(spark, [(0, None)])).count() == 0


def kinds_of_vectors():
    rng = np.random.default_rng(11)
    yield "gaussian", rng.normal(size=(6000, 16))
    yield "clustered", rng.normal(size=(40, 8))[rng.integers(0, 40, 6000)] + 0.05 * rng.normal(size=(6000, 8))
    yield "uneven lengths", rng.normal(size=(6000, 12)) * rng.lognormal(0, 1, (6000, 1))


def test_the_default_finds_all_neighbours_of_three_kinds_of_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 2500)
    for name, points in kinds_of_vectors():
        points = points.astype(np.float32)
        wide = points.astype(np.float64)
        found = collections.defaultdict(set)
        for r in ann.nearest(vectors(spark, list(enumerate(points.tolist()))), every=200).collect():
            found[r["query_id"]].add(r["vec_id"])
        for q in range(0, 6000, 200):
            scores = wide @ wide[q]
            scores[q] = -np.inf
            assert found[q] == set(np.argsort(-scores)[:20].tolist()), name


def test_odd_lengths_and_repeated_ids(spark):
    rows = [(0, [9.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [2.0, 0.0])]
    found = sorted(tuple(r) for r in ann.nearest(vectors(spark, rows)).collect())
    assert found == sorted([(20, 1, 1, 1.0), (20, 2, 2, 0.0), (20, 3, 20, 0.0),  # of [0, 1]
                            (20, 1, 2, 2.0), (20, 2, 1, 1.0), (20, 3, 20, 0.0)])  # of [1, 0]


# Queries and pipeline ---------------------------------------------------------------------------

def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_covers_its_table(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    whole = {"op1_lm_score", "op3_minhash_near_dedup", "op5_toxicity", "op8_fingerprint"}
    assert found.count() == docs if name in whole else found.count() > 0


def test_stages_keep_the_columns_and_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    by_name = dict(corpus_pipeline.STAGES)
    clean = by_name["toxicity"](spark, docs, SF_DIR).cache()
    gone = docs.select("doc_id").subtract(clean.select("doc_id")).join(labels, "doc_id", "left").collect()
    assert gone and all(r["toxic"] != 0 for r in gone)
    lines = by_name["line_dedup"](spark, clean, SF_DIR).cache()
    assert lines.count() == clean.count() and lines.where("n_chars <> length(text)").count() == 0
    kept = by_name["minhash_near_dedup"](spark, lines, SF_DIR).cache()
    classes = neardup.near_duplicates(lines)
    assert {r[0] for r in kept.select("doc_id").collect()} == {r[0] for r in classes.select("class_id").collect()}
    mixed = by_name["mixing"](spark, kept, SF_DIR).cache()
    for df in (clean, lines, kept, mixed):
        assert df.schema.names == docs.schema.names
    pieces = by_name["packing"](spark, mixed, SF_DIR)
    assert pieces.where(F.col("start") == 0).count() == mixed.count()


def test_stages_take_odd_rows(spark, odd_docs):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == odd_docs.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() >= docs.count()


def test_features_are_counted_a_few_documents_at_a_time(monkeypatch):
    texts = text.as_strings(pa.array(["a b a", None, "", "some words words", " b", "a"]))
    whole = toxicity.Words(texts).counted()
    monkeypatch.setattr(toxicity, "COUNTED_FEATURES", 3)
    parts = toxicity.Words(texts).counted()
    assert [p.tolist() for p in parts] == [w.tolist() for w in whole]
    assert sum(p.itemsize for p in parts) == 12  # 24 bytes an entry before, 12 now
    assert toxicity.Words(texts.slice(0, 0)).counted()[0].tolist() == []


def _texts_with_one_window(rng, number, held):
    """Windows of one min-hash in ``number`` texts: in each own shingles, but those of ``held`` in its place."""
    rows = rng.integers(0, 2 ** 63, (number, 161), np.uint64)
    rows[:, 80] = 7
    for texts, begin, end in held:
        rows[texts, begin:end] = rows[texts[0], begin:end]
    windows = np.zeros(number, passages.WINDOW)
    windows["text"], windows["at"], windows["right"] = np.arange(number), 80, 160
    around = [passages.neighbourhoods(row) for row in rows]
    windows["before"], windows["behind"] = [b[80] for b, _ in around], [b[80] for _, b in around]
    return windows


def test_every_pair_of_a_group_that_shares_a_passage_is_linked():
    """Pairs whose neighbours in both orders share more, on one side, than their own partners do."""
    rng = np.random.default_rng(5)
    for number in (40, 400):
        held = [([0, *range(4, number)], 60, 100)]  # too short, but next to each other in both orders
        held += [([1, 3], 60, 120), ([2, number - 1], 45, 95), ([0, number // 2], 66, 113)]
        links, kept = passages.joined(_texts_with_one_window(rng, number, held), 46)
        found = {(a, b) for a, b in zip(links["a"].tolist(), links["b"].tolist())}
        assert {(1, 3), (2, number - 1), (0, number // 2)} <= found
        assert len(kept) == number


def test_each_of_many_texts_is_linked_with_one_that_shares_its_passage():
    """Passages of the least length around a common shingle, each held by two or three of a thousand texts."""
    rng, number = np.random.default_rng(6), 1000
    order, held = rng.permutation(number).tolist(), [(list(range(number)), 64, 97)]
    for at in range(0, 900, 3):
        begin = int(rng.integers(36, 80))
        held.append((order[at:at + 3], begin, begin + 46))
    links, _ = passages.joined(_texts_with_one_window(rng, number, held), 46)
    pairs = set(zip(links["a"].tolist(), links["b"].tolist()))
    for texts, _, _ in held[1:]:
        for t in texts:
            assert any((min(t, o), max(t, o)) in pairs for o in texts if o != t)


def test_stretches_of_many_pairs_are_those_of_each():
    import pyarrow as pa
    rng = np.random.default_rng(8)
    ones, others = [], []
    for n in range(600):
        one = rng.integers(0, 99, rng.integers(0, 150), "u4")
        other = np.where(rng.random(len(one)) < rng.choice([0, 0.05, 0.3, 0.97]), 100, one).astype("u4")
        if n % 3 == 0 and len(one) > 3:  # one run alike
            other = np.full(len(one), 100, "u4")
            x, y = sorted(rng.integers(0, len(one) + 1, 2))
            other[x:y] = one[x:y]
        ones.append(one)
        others.append(other[:len(other) - n % 4 % 3])
    for span in (5, 30):
        rows = [pa.array([r.tobytes() for r in rows], pa.binary()) for rows in (ones, others)]
        for begin, size in ((0, 600), (13, 100)):
            found = sorted(zip(*(c.tolist() for c in passages.stretches_of_pairs(
                rows[0].slice(begin, size), rows[1].slice(begin, size), span))))
            want = []
            for at, (one, other) in enumerate(zip(ones[begin:begin + size], others[begin:begin + size])):
                one, other = one[:len(other)], other[:len(one)]
                reach = passages.reaches(one, other)
                whole, parts = (passages.of_length(*reach, s) for s in (span, passages.PART))
                for x, y in sorted({*whole, *parts}):
                    kind = 2 if (x, y) in whole and (x, y) in parts else int((x, y) in whole)
                    want.append((at, x, y, int((one[x:y + 1] == other[x:y + 1]).sum()), kind))
            assert found == sorted(want) and len({k for *_, k in want}) > 1


def test_records_come_back_from_planes():
    rng = np.random.default_rng(9)
    links = np.frombuffer(rng.bytes(passages.LINK.itemsize * 50), passages.LINK)
    parts = [passages.planes(p) for p in (links[:20], links[20:20], links[20:])]
    assert (passages.from_planes(parts, passages.LINK) == links).all()
    assert len(passages.from_planes([], passages.LINK)) == 0


def test_windows_that_nothing_shares_come_through():
    rng = np.random.default_rng(10)
    windows = np.zeros(300, passages.WINDOW)
    windows["key"], windows["text"], windows["right"] = rng.integers(0, 200, 300), np.arange(300), 60
    windows["before"], windows["behind"] = rng.integers(0, 9, 300), rng.integers(0, 9, 300)
    alone = [k for k, n in zip(*np.unique(windows["key"], return_counts=True)) if n == 1]
    _, kept = passages.joined(windows, 46)
    assert set(alone) <= set(kept["key"].tolist()) and set(kept["key"].tolist()) == set(windows["key"].tolist())
    assert len(passages.joined(windows[np.isin(windows["key"], alone)], 46)[1]) == len(alone)


def test_freed_memory_goes_back_when_a_task_ends():
    import os
    import pyarrow as pa
    from tickloom.llm.text import tidied

    def held():
        with open(f"/proc/{os.getpid()}/statm") as file:
            return int(file.read().split()[1]) * 4096

    last = []

    def run(batches):
        many = [bytearray(50_000) for _ in range(4000)]
        last.append(bytearray(50_000))  # stays behind them
        yield pa.record_batch({"n": [len(many)]})

    before = held()
    list(tidied(run)(iter([])))
    assert held() - before < 60_000_000


def test_links_of_large_groups_come_in_parts(monkeypatch):
    rng = np.random.default_rng(8)
    groups = [_texts_with_one_window(rng, 200, [(list(range(200)), 60, 110)]) for _ in range(4)]
    for number, windows in enumerate(groups):
        windows["key"] = number
        windows["text"] += 1000 * number
    windows = np.concatenate(groups)
    whole, kept = passages.joined(windows, 46)
    monkeypatch.setattr(passages, "GATHERED", 300)
    monkeypatch.setattr(passages, "HELD", 100)
    monkeypatch.setattr(passages, "COMPARED", 100)
    links, same = passages.linked(windows, 46)
    parts = list(links)
    assert len(parts) > 5 and max(map(len, parts)) < len(whole) / 2
    assert {r.tobytes() for part in parts for r in part} == {r.tobytes() for r in whole}
    assert (same == kept).all()


def test_no_shuffle_files_of_finished_steps_stay(spark):
    """While the passages of a table are looked for, only the last step's files may lie on the disk."""
    def files():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        found = manager.getAllFiles()
        found = [found.apply(i) for i in range(found.size())]
        return {f.getName() for f in found if f.getName().startswith("shuffle_") and f.length() > 1000}

    rng, before = random.Random(9), files()
    passage = words(rng, 80)
    texts = [" ".join(words(rng, 40) + passage + words(rng, 40)) for _ in range(12)]
    found = passages.repeated_passages(documents(spark, texts))
    for _ in range(100):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert found.count() == 12
    assert spark.conf.get(CLEANUP, None) != "true"


def test_word_counts():
    rng = random.Random(10)
    texts = ["".join(rng.choice("ab \t\n\x0b\x0c\r\x1f\u00e9\u3000\u0085") for _ in range(rng.randrange(9)))
             for _ in range(500)] + [None, "", " "]
    counts = text.word_counts(text.as_strings(pa.array(["a b", *texts]).slice(1)))
    assert counts.tolist() == [len(re.findall(text.WORD_PATTERN, t or "")) for t in texts]
