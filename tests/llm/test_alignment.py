"""Cross-tokenizer alignment against the plain definition."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.conftest import CLASHING, documents
from tickloom.llm import alignment
from tickloom.llm.catalog import QUERIES

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD_TEXTS = [None, "", " ", "two  spaces", " leading", "trailing ", "a \n b", "tab\t word", "x▁y", "x<0x0A>y",
             "<|endoftext|> inside <|endoftext|>", "<s> </s> <unk>", "don't we'll 12 345,6!!  ?", "é 漢字 한글 \U0001F600 ok",
             "a 　b", "\x00 a", "漢字" * 300, "\U0001F600" * 200 + " ok", "w " * 3000 + "w"]
ALPHABET = ["a", "the", " ", " ", "  ", "\n", "é", "漢", "\U0001F600", "<", ">", "|", "1", "23", ".", "don't", "　", "\t", "▁"]


def plain_groups(text, coders):
    """Token ids of both kinds by group; none for a text whose tokens do not join to it."""
    tokenizer, model = coders
    if not text:
        return []
    a, b = tokenizer.encode(" " + text, add_special_tokens=False), model.encode(text)
    letters = alignment.byte_values()
    names = [model.id_to_piece(i) for i in b]
    as_bytes = ([bytes(letters[c] for c in token) for token in a.tokens],
                [bytes([int(name[3:-1], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode()
                 for i, name in zip(b, names)])
    if any(b"".join(own) != (" " + text).encode() for own in as_bytes):
        return []
    ends = [np.cumsum([len(x) for x in own]).tolist() for own in as_bytes]
    groups, begin_a, begin_b = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        end_a, end_b = ends[0].index(end) + 1, ends[1].index(end) + 1
        groups.append((a.ids[begin_a:end_a], b[begin_b:end_b]))
        begin_a, begin_b = end_a, end_b
    return groups


def plain_rows(rows):
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    coders = tokenizer, sentencepiece.SentencePieceProcessor(model_file=PIECES)
    aligned = [(i, plain_groups(t, coders)) for i, t in rows]
    links = [collections.Counter((x, y) for a, b in own for x in a for y in b) for _, own in aligned]
    counts = collections.Counter(pair for own in links for pair in own)
    most = collections.defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for (i, own), linked in zip(aligned, links):
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
        out.append((i, sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), sum(linked.values()),
                    sum(n for (x, y), n in linked.items() if counts[x, y] == most[x]),
                    sum(n * counts[p] for p, n in linked.items()),
                    hashlib.sha256(written.encode()).hexdigest() if written else ""))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [200, alignment.BLOCK_BYTES])
def test_query_against_definition(spark, tmp_path, monkeypatch, block_bytes):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block_bytes)
    rng = random.Random(block_bytes)
    texts = ODD_TEXTS + ["".join(rng.choices(ALPHABET, k=rng.randint(0, 40))) for _ in range(200)]
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(40).collect()
    texts += [r["text"] for r in given]
    documents(spark, texts).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op13_tokenizer_alignment"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found), key=str) == plain_rows(list(enumerate(texts)))


@pytest.mark.parametrize("seed", range(20))
def test_galloping_intersection(seed):
    rng = np.random.default_rng(seed)
    lists = [[np.sort(rng.choice(400, rng.integers(0, 300), replace=False)) + 1000 * d for d in range(12)]
             for _ in range(2)]
    ends = [np.concatenate(own).astype(np.int64) for own in lists]
    starts = [np.cumsum([0, *map(len, own)]) for own in lists]
    in_a, in_b = alignment.common_ends(ends[0], starts[0], ends[1], starts[1])
    assert ends[0][in_a].tolist() == np.intersect1d(*ends).tolist()
    assert (ends[0][in_a] == ends[1][in_b]).all()


def test_wide_groups_are_counted(monkeypatch):
    """Few ends in common: the links of a group are the product of its sides."""
    a, b = np.array([1, 2, 1, 3, 1]), np.array([5, 6, 5, 5])
    whole = [np.array([0]), np.array([5]), np.array([0]), np.array([4])]
    plain = collections.Counter((x, y) for x in a.tolist() for y in b.tolist())
    for limit in (1, 100):
        monkeypatch.setattr(alignment, "WIDE_GROUP", limit)
        own, pairs, links = alignment.linked_pairs(a, b, np.array([0]), *whole, (10, 10))
        assert {divmod(p, 10): n for p, n in zip(pairs.tolist(), links.tolist())} == plain


def test_odd_rows(odd_docs, no_docs):
    found = alignment.align(odd_docs, BYTES, PIECES)
    rows = found.collect()
    assert len(rows) == 9 and set(CLASHING) <= set(found.select("_rest.*").columns)
    same = [r for r in rows if r["doc_id"] == 4]
    assert len(same) == 2 and same[0] == same[1] and same[0]["groups"].count(";") == same[0]["n_groups"] - 1
    assert all(r["groups"] == "" and r["count_sum"] == 0 for r in rows if r["doc_id"] in (0, 1))
    assert alignment.align(no_docs, BYTES, PIECES).count() == 0
