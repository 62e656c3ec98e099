"""Exact duplicates, alignment of two tokenizers and ranked search against plain versions."""

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from retailflow.llm import align, exact, lexical, queries
from retailflow.llm.common import table

BYTE_BPE, PIECE_BPE = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
SF = "/root/testdata/sf0.001"
#: Names that operators use inside; as columns of the input they must not matter.
CLASHING = ("row", "n", "size", "digest", "hash", "print", "slice", "plain", "terms", "score", "rank", "item", "_part", "first")
EDGE_TEXTS = [
    None, "", " ", "\n\n  \t", "word", "It's we're I'll 'tis 's 'sail don'tknow", "a<|endoftext|>b <s> </s> <unk> <0x41>", "ÀÉß İstanbul ﬁn é",
    "日本語のテキスト mixed with latin", "emoji 👩‍👩‍👧 and ümläut", "tabs\tand\x0bvertical\x0c feeds\x85nel\xa0nbsp", "123 4567 ²³ ½ ². x²",
    "x" * 5000, "word " * 30_000, "end with spaces   ", "   begin", "!!! ??? ...'s", "\x00\x01 control", "same text twice", "same text twice",
    "a▁b ▁ c", "▁", "if (x) {\r\n  y();\r\n}\r", "double  space  here", "x\n y \n\nz \n w", "wo rd", "w\to\nr\x0bd", "w\x85ord", " x   y",
    "    indented = code(a, b);", "the the of", "THE of the", "the", "of the", "　\x1c x",
]


def frame(spark, rows, clash=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING}) if clash else df


ROWS = [*enumerate(EDGE_TEXTS), (None, "no id here"), (None, "word"), (3, "an id again"), (3, "an id again"), (None, None)]


# exact duplicates


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, (1 << 20) - 1), max_size=80), min_size=1, max_size=6), st.integers(20, 64))
def test_filters_merge_without_loss(parts, bits):
    filters = [exact.CountingQuotientFilter.of(bits, np.array(p, np.uint64)) for p in parts]
    loaded = [exact.CountingQuotientFilter.load(f.dump()) for f in filters]
    prints, counts = exact.CountingQuotientFilter.merged(loaded).items()
    assert dict(zip(prints.tolist(), counts.tolist())) == Counter(x for p in parts for x in p)
    assert prints.tolist() == sorted(prints.tolist())


def test_a_filter_of_random_prints_is_small():
    prints = np.unique(np.random.default_rng(1).integers(0, 1 << 36, 1 << 20, np.uint64))
    assert len(exact.CountingQuotientFilter.of(36, prints).dump()) < 4.5 * len(prints)


def plain_groups(rows):
    """(doc_id, keep_id, group size, digest) of every row, and how many rows of a group are kept."""
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub("[\\x20\\x09-\\x0D]", "", t or ""), []).append((i, t or ""))
    want = []
    for plain, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0]))[0]
        digest = hashlib.sha256(plain.encode()).digest()
        want += [(i, keep, len(members), digest) for i, _ in members]
    return Counter(want), len(groups)


@pytest.mark.parametrize("remainder_bits, filter_rows", [(16, 1 << 20), (0, 8), (-4, 4)])
def test_exact_duplicates(spark, remainder_bits, filter_rows):
    """Few fingerprint bits make different texts meet; only bytes decide."""
    rnd = random.Random(3)
    rows = ROWS + [(1000 + i, " ".join(rnd.choices("ab", k=rnd.randint(1, 5)))) for i in range(300)]
    found = exact.exact_duplicates(frame(spark, rows).repartition(5), remainder_bits=remainder_bits, filter_rows=filter_rows).collect()
    want, groups = plain_groups(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, bytes(r.digest)) for r in found) == want
    kept = [r for r in found if r.kept]
    assert len(kept) == groups and all(r.doc_id == r.keep_id for r in kept)


def test_exact_duplicates_of_nothing_and_of_one_text(spark):
    assert exact.exact_duplicates(frame(spark, [])).collect() == []
    found = exact.exact_duplicates(frame(spark, [(i % 7, "same " * (i % 3)) for i in range(500)], clash=False)).collect()
    sizes = Counter(r.group_size for r in found)
    assert sizes == {167: 334, 166: 166}
    assert sum(r.kept for r in found) == 3


# alignment


@given(st.sets(st.integers(0, 300), max_size=60), st.sets(st.integers(0, 300), max_size=200))
def test_galloping_finds_the_common_ends(a, b):
    a, b = sorted(a), sorted(b)
    i, j = align.common_ends(np.array(a, np.int64), np.array(b, np.int64))
    assert list(zip(i.tolist(), j.tolist())) == [(a.index(x), b.index(x)) for x in a if x in set(b)]


def test_galloping_in_long_lists():
    rnd = np.random.default_rng(4)
    for n, m in ((5000, 70_000), (70_000, 5000), (3000, 3000), (1, 10_000)):
        a, b = (np.unique(rnd.integers(0, 100_000, k)) for k in (n, m))
        i, j = align.common_ends(a, b)
        assert (a[i] == b[j]).all() and len(i) == len(np.intersect1d(a, b))


class Plain:
    """Each whole text by the libraries, ends compared as sets."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(BYTE_BPE), SentencePieceProcessor(model_file=PIECE_BPE)
        self.a.encode_special_tokens = True
        printable = [c for c in range(256) if chr(c).isprintable() and c not in (32, 173)]
        others = [c for c in range(256) if c not in printable]
        self.byte = {chr(c): c for c in printable} | {chr(256 + i): c for i, c in enumerate(others)}

    def b_token(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()

    def align(self, text):
        """Groups and links, or None without tokens."""
        if not text:
            return None
        data = (" " + text).encode()
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        a_tokens = [bytes(self.byte[c] for c in self.a.id_to_token(i)) for i in a]
        b_tokens = [self.b_token(i) for i in b]
        if b"".join(a_tokens) != data or b"".join(b_tokens) != data:
            return None
        a_ends, b_ends = ([*accumulate(map(len, t))] for t in (a_tokens, b_tokens))
        common = sorted(set(a_ends) & set(b_ends))
        groups, links, i, j = [], [], 0, 0
        for end in common:
            p, q = bisect_left(a_ends, end), bisect_left(b_ends, end)
            groups.append(",".join(map(str, a[i : p + 1])) + "|" + ",".join(map(str, b[j : q + 1])))
            links.append((a[p], b[q]))
            i, j = p + 1, q + 1
        return len(a), len(b), groups, links

    def table(self, rows):
        each = [(i, self.align(t)) for i, t in rows]
        counts = Counter(x for _, e in each if e for x in e[3])
        best = {}
        for (_, second), n in counts.items():
            best[second] = max(n, best.get(second, 0))
        out = []
        for i, e in each:
            if e is None:
                out.append((i, 0, 0, 0, 0, 0, 0, ""))
                continue
            n_a, n_b, groups, links = e
            top = sum(counts[x] == best[x[1]] for x in links)
            digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
            out.append((i, n_a, n_b, len(groups), len(links), top, sum(counts[x] for x in links), digest))
        assert len(counts) <= align.most_pairs(BYTE_BPE, PIECE_BPE) < 3_000_000
        return Counter(out)


def test_alignment_of_edge_texts(spark):
    found = align.alignments(frame(spark, ROWS).repartition(3), BYTE_BPE, PIECE_BPE).drop("links").collect()
    assert Counter(map(tuple, found)) == Plain().table(ROWS)
    assert {r.n_a for r in found if r.doc_id == 20} == {0}  # U+2581 is no space
    assert align.alignments(frame(spark, []), BYTE_BPE, PIECE_BPE).collect() == []


def test_alignment_of_random_characters(spark):
    rnd = random.Random(5)
    alphabet = "ab  \n\t'sterndé²½.(){};\r\x1c\xa0 ▁1Xx日👩"
    rows = [(i, "".join(rnd.choices(alphabet, k=rnd.randint(1, 40)))) for i in range(3000)]
    found = align.alignments(frame(spark, rows), BYTE_BPE, PIECE_BPE).drop("links").collect()
    assert Counter(map(tuple, found)) == Plain().table(rows)


def test_alignment_with_a_full_cache(spark, monkeypatch):
    monkeypatch.setattr(align, "KEPT_PARTS", 40)
    both = align.Tokenizers(BYTE_BPE, PIECE_BPE)
    for text in ["many different words in a row " * 2, "that do not fit into a cache of parts"] * 2:
        parts = both.cut(" " + text)
        found = both.of([parts])
        assert set(found) == set(parts) and len(both.late) <= 40 and len(both.before) <= 40
        assert "".join(found[p][3] for p in parts) == ";".join(Plain().align(text)[2]) + ";"


def test_registered_alignment_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    found = queries.op12_token_alignment(spark, SF).collect()
    assert Counter(map(tuple, found)) == Plain().table(rows)


# ranked search


def plain_search(docs, items, k=20):
    pattern = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def split(text):
        return pattern.findall((text or "").translate(lower))

    counts = [(i, Counter(split(t))) for i, t in docs]
    big_n, total = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            score = 0
            for t in split(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + (25 * sum(c.values()) * big_n) // total
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, rank, i, -score) for rank, (score, _, i) in enumerate(sorted(scored)[:k], 1)]
    return Counter(out)


ITEMS = [
    (0, "the of and the"), (1, "of the sea"), (2, "The OF and word"), (3, None), (4, ""), (5, "nothing here matches zzz"), (6, "...!"),
    (None, "of the land"), (0, "the of and the"), (7, "word word word " * 50), (8, "ÀÉß é 日本語のテキスト"), (9, "a b c d e f g h of the and"),
]


@pytest.mark.parametrize("k, limits", [(20, {}), (3, {"most_items": 2}), (1, {"most_terms": 3}), (20, {"most_bytes": 1})])
def test_search(spark, k, limits):
    rnd = random.Random(7)
    words = "the of and sea land word a b c d e f g h Ä".split()
    docs = ROWS + [(100 + i // 2, " ".join(rnd.choices(words, k=rnd.randint(1, 30)))) for i in range(400)]
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("rank", F.lit("x"))
    found = lexical.search(frame(spark, docs).repartition(7), items.coalesce(1), k=k, **limits).collect()
    assert Counter(map(tuple, found)) == plain_search(docs, ITEMS, k)


def test_search_in_small_steps(spark, monkeypatch):
    monkeypatch.setattr(lexical, "HELD_SUMS", 100)
    docs = [(i, f"word{i % 5} the " * (1 + i % 3)) for i in range(300)]
    items = [(i, f"the word{i} word{i + 1}") for i in range(5)]
    found = lexical.search(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert Counter(map(tuple, found)) == plain_search(docs, items)


def test_search_of_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(frame(spark, []), items).collect() == []
    assert lexical.search(frame(spark, ROWS), items.limit(0)).collect() == []
    assert lexical.search(frame(spark, [(1, None), (2, "")]), items).collect() == []


def test_length_factors_beyond_64_bits():
    n = np.array([0, 1, 10**9], np.int64)
    want = [75 + 25 * int(x) * 10**11 // 10**14 for x in n]
    assert lexical.length_factor(n, 10**11, 10**14).tolist() == want


@pytest.mark.parametrize("seed", range(4))
def test_the_graph_adds_each_items_terms(seed):
    rnd = random.Random(seed)
    common = [b"t%d" % i for i in range(8)]
    items = [Counter(rnd.choices(common, k=rnd.randint(0, 12)) + [b"own%d" % i] * (i % 3)) for i in range(40)]
    plan = lexical.Plan(items).ready()
    values = np.array([rnd.randint(1, 1 << 40) for _ in plan.vocabulary], np.int64)
    every = np.arange(len(values))
    scores = plan.scores(every, np.zeros(len(every), np.int64), values, 1)[:, 0]
    assert scores.tolist() == [sum(n * int(values[plan.vocabulary[t]]) for t, n in item.items()) for item in items]
    unshared = sum(max(0, sum(item.values()) - 1) for item in items)
    assert len(plan.sums) < 0.6 * unshared  # sums are shared
