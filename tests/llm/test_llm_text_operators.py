"""Token counts, packing, repeated passages and near-duplicates against plain versions."""

import hashlib
import random
import re
import struct
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from retailflow.llm import alphabet, minhash, packing, substrings, tokens

BYTE_BPE, WORD_BPE = map(public_tokenizers.path, ("byte_bpe_50k.json", "word_bpe_49k.json"))
#: Names that operators use inside; as columns of the input they must not matter.
CLASHING = ("row", "score", "kind", "block", "component", "rep", "digest", "n_tokens", "ids", "_id", "_text", "a", "b")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, clash=True):
    """Documents of (doc_id, text), with extra columns of clashing names."""
    df = spark.createDataFrame([(i, t, "en", "src0", len(t) if t else None) for i, t in rows], DOCS)
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING}) if clash else df


EDGE_TEXTS = [
    None, "", " ", "\n\n  \t", "word", "It's we're I'll 'tis 's", "a<|endoftext|>b <|startoftext|> c", "ÀÉß İstanbul ﬁn é",
    "日本語のテキスト mixed with latin", "emoji 👩‍👩‍👧 and ümläut", "tabs\tand\x0bvertical\x0c feeds\x85nel\xa0nbsp", "123 4567 ²³ ½",
    "x" * 5000, "word " * 30_000, "end with spaces   ", "   begin", "!!! ??? ...'s", "\x00\x01 control", "same text twice", "same text twice",
]


def test_the_fast_split_agrees_with_the_library_on_every_code_point():
    byte, word = Tokenizer.from_file(BYTE_BPE), Tokenizer.from_file(WORD_BPE)
    for c in map(chr, range(alphabet.LIMIT)):
        text = f"a{c}1 {c}{c} '{c}  {c}b!{c}\n{c}"
        if not alphabet.plain(text, ()):
            continue
        want = [text[a:b] for _, (a, b) in byte.pre_tokenizer.pre_tokenize_str(text)]
        assert alphabet.BYTE_LEVEL.findall(text) == want, hex(ord(c))
        pieces = alphabet.WORD_LEVEL.findall(text.lower())
        alone = [i for p in pieces for i in word.encode(p, add_special_tokens=False).ids]
        assert alone == word.encode(text, add_special_tokens=False).ids, hex(ord(c))


@pytest.mark.parametrize("size", [0, 5, 65_536])
def test_token_counts_are_the_librarys(spark, size):
    rows = [*enumerate(EDGE_TEXTS), (None, "no id here"), (3, "an id again")]
    tok = Tokenizer.from_file(BYTE_BPE)
    want = Counter((i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False))) for i, t in rows)
    got = tokens.count_tokens(frame(spark, rows), BYTE_BPE, size=size or 1)
    assert Counter(map(tuple, got.collect())) == want


def test_a_full_cache_keeps_counting_right(spark, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_SIZE", 50)
    tok, own = Tokenizer.from_file(BYTE_BPE), tokens.Lengths(BYTE_BPE)
    rnd = random.Random(1)
    for _ in range(30):
        pieces = [" " + "".join(rnd.choices("abcdefgh", k=rnd.randint(1, 80))) for _ in range(70)]
        assert own.total(pieces) == sum(len(tok.encode(p, add_special_tokens=False)) for p in pieces)


def packed(spark, rows, **kw):
    return packing.pack_documents(frame(spark, rows), WORD_BPE, **kw).collect()


def check_packing(rows, got):
    tok = Tokenizer.from_file(WORD_BPE)
    want = Counter(tuple([*tok.encode(t or "", add_special_tokens=False).ids, 2]) for _, t in rows)
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        ids = struct.unpack(f"<{r.length}I", r.ids)
        sequences[r.sequence_id].append((r.offset, r.length, r.window, r.step_group))
        pieces[r.doc_id].append((r.start, ids, r.doc_tokens))
    for parts in sequences.values():
        at = 0
        for offset, length, window, _ in sorted(parts):
            assert offset == at
            at += length
        assert at == window <= 4096 and window & (window - 1) == 0  # full: no padding at all
    groups = defaultdict(set)
    for s, parts in sequences.items():
        groups[parts[0][3]].add((s, parts[0][2]))
    totals = [sum(w for _, w in g) for g in groups.values()]
    assert all(t <= packing.STEP_TOKENS for t in totals)
    return want, pieces, totals


def test_packing_keeps_every_id_once_and_fills_every_window(spark):
    rows = list(enumerate(EDGE_TEXTS)) + [(100 + i, f"some words number {i} " * (i * 7 % 60)) for i in range(200)]
    want, pieces, totals = check_packing(rows, packed(spark, rows))
    made = Counter()
    for parts in pieces.values():
        ids = []
        for start, piece, total in sorted(parts):
            assert start == len(ids)
            ids += piece
        assert len(ids) == total
        made[tuple(ids)] += 1
    assert made == want
    tok = Tokenizer.from_file(WORD_BPE)
    assert all(sum(len(p) for _, p, _ in pieces[i]) == len(tok.encode(t or "", add_special_tokens=False)) + 1 for i, t in rows)


def test_packing_repeated_and_missing_ids(spark):
    rows = [(1, "one two three"), (1, "one two three"), (None, "no id"), (None, None)]
    want, pieces, _ = check_packing(rows, packed(spark, rows))
    assert sum(len(p) for parts in pieces.values() for _, p, _ in parts) == sum(len(ids) * n for ids, n in want.items())


def test_a_full_word_cache_keeps_encoding_right(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_SIZE", 40)
    tok, own, rnd = Tokenizer.from_file(WORD_BPE), packing.WordIds(WORD_BPE), random.Random(2)
    for _ in range(20):
        texts = [" ".join("".join(rnd.choices("abcdeé", k=rnd.randint(1, 70))) for _ in range(30)) for _ in range(5)]
        assert own.encode(texts) == [struct.pack(f"<{len(i)}I", *i) for i in (tok.encode(t, add_special_tokens=False).ids for t in texts)]


def test_full_step_groups_are_even():
    packer = packing.Packer()
    rnd, totals = random.Random(3), []
    for i in range(3000):
        packer.route((i, 0, b"\x01\0\0\0" * rnd.randint(1, 6000), 0))
        if packer.pooled > 200_000:
            packer.pack()
            totals += [sum(w for w, _ in g) for g in packer.steps(False)]
    packer.finish()
    totals += [sum(w for w, _ in g) for g in packer.steps(True)]
    assert set(totals[:-1]) == {packing.STEP_TOKENS} and len(totals) > 100


_SPLIT = re.compile("[^\x20\x09-\x0d]+")


def plain_passages(rows, width):
    first, out = {}, []
    for i, t in rows:
        words = _SPLIT.findall(t or "")
        for k in range(len(words) - width + 1):
            w = tuple(words[k : k + width])
            if i is not None:
                first[w] = min(first.get(w, i), i)
    for i, t in rows:
        words = _SPLIT.findall(t or "")
        gone = [False] * len(words)
        for k in range(len(words) - width + 1):
            if i is not None and first[tuple(words[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        out.append((i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return Counter(out)


def passages(seed=5):
    rnd = random.Random(seed)
    words = ["w%d" % i for i in range(300)] + ["é", "A", "a", "日本"]
    shared = [" ".join(rnd.choices(words, k=rnd.randint(5, 40))) for _ in range(8)]
    rows = [(i, "\t".join(rnd.sample(shared, rnd.randint(0, 3)) + [" ".join(rnd.choices(words, k=rnd.randint(0, 60)))])) for i in range(150)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)]  # many copies
    rows += [(None, rows[3][1]), (None, None), (-5, rows[9][1]), (2**60, shared[0]), (20, rows[20][1]), (21, "again " * 50), (22, "x" * 100_000)]
    return rows + list(zip(range(5000, 5020), EDGE_TEXTS))


@pytest.mark.parametrize("kw", [{}, {"docs_per_block": 16}, {"docs_per_block": 8, "coarse": 3}, {"width": 5, "docs_per_block": 30}])
def test_repeated_passages_equal_the_plain_version(spark, kw):
    rows = passages()
    got = substrings.repeated_passages(frame(spark, rows), **kw).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got) == plain_passages(rows, kw.get("width", 13))
    for r in got:
        spans = [(s["first"], s["end"]) for s in r.removed]
        assert sum(b - a for a, b in spans) == r.n_removed
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))  # maximal: they do not touch


def test_window_hashes_equal_the_polynomial():
    import numpy as np

    w = np.random.default_rng(1).integers(0, 1 << 63, 50, np.uint64)
    want = [sum(int(x) * substrings.BASE ** (4 - j) for j, x in enumerate(w[i : i + 5])) % 2**64 for i in range(46)]
    assert substrings.rolling(w, 5).tolist() == want
    hashes = np.sort(substrings.rolling(w, 5))
    assert (substrings._grown(substrings._shrunk(hashes)) == hashes).all()


def plain_components(rows, percent):
    def shingles(t):
        words = _SPLIT.findall((t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        return frozenset(map(tuple, (words[i : i + 5] for i in range(len(words) - 4)) if len(words) >= 5 else [words] * bool(words)))

    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, s) in enumerate(sets):
        for j, o in sets[:k]:
            if s and o and None not in (i, j) and 100 * len(s & o) >= percent * len(s | o):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return Counter((i, len(s), root(i), i is None or root(i) == i) for i, s in sets)


def near_copies(seed=6):
    """Texts with exact copies, a hub of near copies whose pairs lie on both
    sides of the threshold, and a chain."""
    rnd = random.Random(seed)
    words = ["w%d" % i for i in range(2000)]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(1, 120)))) for i in range(120)]
    base = rnd.choices(words, k=150)
    for i in range(150):
        copy = list(base)
        for _ in range(rnd.randint(0, 4)):
            copy[rnd.randrange(150)] = "changed%d" % rnd.randrange(10**6)
        rows.append((rnd.randrange(10**6, 10**7), " ".join(copy)))
    chain = rnd.choices(words, k=200)
    for i in range(25):
        chain = chain[4:] + rnd.choices(words, k=4)
        rows.append((500 - i, " ".join(chain).title()))
    rows += [(700 + i, rows[4][1]) for i in range(30)] + [(None, rows[4][1]), (None, None), (800, "one two"), (801, "ONE  two"), (802, "one")]
    return rows + list(zip(range(5000, 5020), EDGE_TEXTS))


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates_equal_all_pairs(spark, percent):
    rows = near_copies()
    got = minhash.near_duplicates(frame(spark, rows), percent=percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == plain_components(rows, percent)


def test_members_split_after_the_first_round_are_compared_with_each_other(spark, monkeypatch):
    """With one row a band, buckets hold texts that are not like their smallest member."""
    monkeypatch.setattr(minhash, "ROWS", 1)
    monkeypatch.setattr(minhash, "_BAND", minhash._BAND[:, :1])
    rows = [r for r in near_copies(8) if r[1] and len(r[1]) < 2000]
    import retailflow.llm.minhash as m

    got = m.near_duplicates(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == plain_components(rows, 85)


def test_equal_rows_are_one_set(spark, monkeypatch):
    """A thousand equal rows and two near copies cost no more than one such row."""
    words = [f"w{i}" for i in range(120)]
    near = [(5, " ".join(words[:-1])), (6, " ".join(words[1:]))]
    sizes = {}
    for k in (1, 1000):
        seen = sizes.setdefault(k, {})

        def counted(df, label):
            out = kept(df, label)
            seen[label] = seen.get(label, 0) + out.count()
            return out

        from retailflow.llm import common

        kept = common.written
        monkeypatch.setattr(minhash, "written", counted)
        rows = [(3, " ".join(words))] * k + near
        got = minhash.near_duplicates(frame(spark, rows)).collect()
        monkeypatch.setattr(minhash, "written", kept)
        assert Counter((r.doc_id, r.component_id, r.kept) for r in got) == {(3, 3, True): k, (5, 3, False): 1, (6, 3, False): 1}
    assert sizes[1].pop("sketches") == 3 and sizes[1000].pop("sketches") == 1002
    assert sizes[1] == sizes[1000]


def test_an_id_with_many_texts(spark):
    """Rows of one id and different texts are judged each by its own text."""
    rnd = random.Random(12)
    texts = [" ".join(rnd.choices("abcdefgh", k=30)) for _ in range(40)]
    rows = [(1, t) for t in texts] + [(100 + i, t) for i, t in enumerate(texts)] + [(500, texts[0] + " x")]
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    assert all(r.component_id == 1 and r.kept == (r.doc_id == 1) for r in got) and len(got) == 81


def test_signature_estimates_are_corrected_for_chance(spark):
    import numpy as np

    rnd = np.random.default_rng(9)
    pairs, want = [], []
    for share in (0.0, 0.3, 0.6, 0.85, 1.0) * 20:
        common = rnd.integers(0, 1 << 63, int(2000 * share / (1 + share)), np.uint64)
        rest = rnd.integers(0, 1 << 63, (2, 1000 - len(common)), np.uint64)
        a, b = (minhash.packed(minhash.minima(np.concatenate([common, r]))) for r in rest)
        pairs.append((a.tolist(), b.tolist()))
        want.append(len(common) / (2000 - len(common)))
    df = spark.createDataFrame(pairs, "a array<long>, b array<long>")
    got = [r[0] for r in df.select(minhash.estimate(F.col("a"), F.col("b"))).collect()]
    errors = np.array(got) - np.array(want)
    assert abs(errors.mean()) < 0.01 and np.abs(errors).max() < 0.16


@pytest.mark.parametrize("run", [
    lambda d: tokens.count_tokens(d, BYTE_BPE), lambda d: packing.pack_documents(d, WORD_BPE),
    substrings.repeated_passages, minhash.near_duplicates,
])
def test_empty_tables_give_no_rows(spark, run):
    assert run(frame(spark, [])).collect() == []


def test_kept_words_hash_as_the_query_does(spark):
    rows = passages(11)[:40]
    got = substrings.repeated_passages(frame(spark, rows)).select("kept", F.sha2("kept", 256).alias("h")).collect()
    assert all(hashlib.sha256(r.kept.encode()).hexdigest() == r.h for r in got)
