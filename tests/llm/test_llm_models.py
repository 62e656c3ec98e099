"""Toxicity, source mixing, URL filter, personal data and the corpus pipeline."""

import hashlib
import importlib
import json
import math
import random
import re
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from retailflow.llm import mixing, pii, queries, toxicity, trees, urls
from retailflow.llm.common import components, table

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("row", "score", "kind", "start", "end", "base", "added", "copy", "_key", "_times", "host", "rule", "verdict", "toxic")


def frame(spark, rows, clash=True):
    df = spark.createDataFrame([(i, t, "en", s, len(t) if t else None) for i, t, s in rows], DOCS)
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING}) if clash else df


# ---- toxicity


def speech(n, seed=1):
    rnd = random.Random(seed)
    words = ["word%s" % "".join(rnd.choices("abcdefgh", k=4)) for _ in range(400)]
    bad = ["vile", "rotten", "awful"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        text = rnd.choices(words, k=rnd.randint(20, 200))
        if toxic:
            for k in range(0, len(text), 12):
                text[k] = rnd.choice(bad)
        rows.append((i, " ".join(text), "src0"))
        labels.append((i, 1, int(toxic)))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_toxic_texts_are_told_from_others_on_held_out_rows(spark):
    rows, labels = speech(600)
    docs = frame(spark, [*rows, (7000, None, None), (7001, "", "a"), (7002, "12 !!", "a"), (None, "vile rotten", "a")])
    found = toxicity.score(docs, toxicity.train(docs, spark.createDataFrame(labels, LABELS))).collect()
    assert len(found) == 604
    held = [(r.score >= 0.5, r.row.doc_id % 5 == 0) for r in found if r.row.doc_id is not None and r.row.doc_id < 7000 and zlib.crc32(str(r.row.doc_id).encode()) % 5 == 0]
    assert len(held) > 80 and sum(a == b for a, b in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found)
    empty = {r.score for r in found if r.row.doc_id in (7000, 7001, 7002)}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert all(r.row.score == "extra score" for r in found)  # clashing names ride along untouched


def test_held_out_labels_do_not_matter(spark):
    rows, labels = speech(300)
    docs = frame(spark, rows)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a, b = (toxicity.train(docs, spark.createDataFrame(x, LABELS)) for x in (labels, turned))
    assert a.ids == b.ids and (a.table == b.table).all() and (a.slope, a.shift) == (b.slope, b.shift)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(1, None, None)], [(i, 1, 1) for i in range(30)]])
def test_without_labels_of_both_kinds_nothing_is_toxic(spark, labels):
    docs = frame(spark, speech(30)[0])
    model = toxicity.train(docs, spark.createDataFrame(labels, LABELS))
    assert all(0 <= r.score < 0.5 for r in toxicity.score(docs, model).collect())
    empty = frame(spark, [])
    assert toxicity.score(empty, toxicity.train(empty, spark.createDataFrame(labels, LABELS))).collect() == []


def test_probabilities_add_up_and_rare_words_back_off():
    counts = np.random.default_rng(1).integers(0, 4, (6, 6)).astype(float)
    counts[3] = 0  # never seen before anything
    shared = np.array([0.1, 0.1, 0.2, 0.3, 0.2, 0.1])
    p = np.exp(toxicity.log_probabilities(counts, shared))
    assert np.allclose(p.sum(axis=1), 1) and (p > 0).all()
    empty = np.exp(toxicity.log_probabilities(np.zeros((6, 6)), shared))
    assert np.allclose(empty, shared)  # nothing seen: what all documents share


def test_word_pairs_are_counted_over_all_texts(spark):
    texts = spark.createDataFrame([("a b a b", 0), ("B, a!", 0), (None, 0), ("c a", 1)], "text string, kind int")
    got = {(r.kind, r.previous, r.word): r.n for r in toxicity.bigrams(texts, {"a": 2, "b": 3}).collect()}
    assert got == {(0, 1, 2): 1, (0, 2, 3): 2, (0, 3, 2): 2, (0, 1, 3): 1, (1, 1, 0): 1, (1, 0, 2): 1}


# ---- mixing


def plain_count(doc_id, mean, seed):
    parts = max(math.ceil(mean / 16), 1)
    m, n = mean / parts, 0
    for part in range(1, parts + 1):
        bits = int(hashlib.md5(f"{seed}:{'null' if doc_id is None else doc_id}:{part}".encode()).hexdigest()[:13], 16)
        u, p, total = (bits + 0.5) / 2**52, math.exp(-m), math.exp(-m)
        for k in range(1, 80):
            n += total < u
            p *= m / k
            total += p
        n += total < u
    return n


def test_copies_equal_inverted_poisson_numbers(spark):
    """The share of the absent source goes to the others in proportion."""
    rows = [(i, f"text {i}", "few" if i < 3 else "some" if i < 60 else "rest" if i < 250 else None) for i in range(300)]
    weights = {"few": 0.5, "some": 0.1, "absent": 0.2}
    n = Counter("few" if s == "few" else "some" if s == "some" else None for _, _, s in rows)
    share = {"few": 0.5 / 0.8, "some": 0.1 / 0.8, None: (1 - 0.5 - 0.1 - 0.2) / 0.8}
    want = Counter()
    for i, t, s in rows:
        k = s if s in weights else None
        want.update((i, t, c) for c in range(1, plain_count(i, len(rows) * share[k] / n[k], 3) + 1))
    got = mixing.mix(frame(spark, rows), weights, seed=3).collect()
    assert Counter((r.row.doc_id, r.row.text, r.copy) for r in got) == want
    assert got[0].row.copy == "extra copy"
    assert any(plain_count(i, len(rows) * 0.5 / 0.8 / 3, 3) > 30 for i in range(3))  # a mean drawn in parts


def test_rows_without_an_id_or_with_a_repeated_one_draw_each_for_itself(spark):
    """A third of all rows has no id, a third one id: both keep their share
    and are spread over the partitions, and a second run repeats the first."""
    rows = [(None, "none", "s") for _ in range(3000)] + [(7, "hot", "s") for _ in range(3000)] + [(100 + i, "own", "s") for i in range(3000)]
    docs = frame(spark, rows, False).repartition(6)
    mixed = mixing.mix(docs, {}, seed=17).select("row.text", "copy", F.spark_partition_id().alias("part"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions would become one
    try:
        got = mixed.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sums = Counter(r.text for r in got)
    assert all(2800 < sums[t] < 3200 for t in ("none", "hot", "own"))
    for text in ("none", "hot", "own"):
        parts = Counter(r.part for r in got if r.text == text)
        assert len(parts) == 8 and max(parts.values()) < 2 * min(parts.values())
    copies = Counter(r.copy for r in got if r.text == "none")
    assert 1500 < copies[1] < 2200 and 500 < copies[2] < 1000  # 1 - 1/e and 1 - 2/e of 3000


def test_only_absent_or_weightless_sources(spark):
    docs = frame(spark, [(i, "t", "a") for i in range(500)], False)
    assert 420 < mixing.mix(docs, {"a": 0.1, "b": 0.9}).count() < 580
    assert mixing.mix(docs, {"a": 0.0, "b": 1.0}).collect() == []


def test_shares_come_near_their_targets_and_the_order_is_shuffled(spark):
    rows = [(i, "t", "big" if i % 10 else "small") for i in range(8000)]
    got = mixing.mix(frame(spark, rows, False), {"small": 0.5}, total=10_000).collect()
    assert 9700 < len(got) < 10_300 and 4800 < sum(r.row.source == "small" for r in got) < 5200
    ids = [r.row.doc_id for r in got]
    assert abs(np.corrcoef(ids, range(len(ids)))[0, 1]) < 0.1


def test_mixing_bounds(spark):
    docs = frame(spark, [(1, "a", "s")])
    assert mixing.mix(frame(spark, []), {"s": 0.5}).collect() == []
    assert mixing.mix(docs, {"s": 0.0}).collect() == []
    assert len(mixing.mix(docs, {}).collect()) == plain_count(1, 1.0, 17)
    with pytest.raises(ValueError):
        mixing.mix(docs, {"s": 0.7, "t": 0.7})


# ---- urls

URLS = [
    None, "", "no scheme", "http://", "http://a.net", "http://A.NET/x", "https://example.net/en/1", "https://m.example.net/en/", "https://example.net/en",
    "http://badexample.net/en/1", "https://example.com/de/9?x=1&y=2#z", "https://EXAMPLE.com/DE/9", "https://x.org/fr/a", "https://org/fr/", "https://xorg/fr/",
    "ftp://u@h.org:21/fr/?", "http://h.org?fr/", "http://h#/fr/", "a://b://c.net/x", "http://ÄÖ.net/ü", "http://example.com/de/\nnext", "http://" + "a" * 5000 + ".net/",
]


def plain_url(url):
    rest = (url or "").partition("://")[2]
    host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups()
    host = host.translate(str.maketrans(urls.A_TO_Z, urls.A_TO_Z.lower()))
    fits = [(len(h + p), v, h + p) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_hosts_paths_and_rules_equal_the_plain_version(spark):
    pages = spark.createDataFrame([(i, u, "<p>") for i, u in enumerate(URLS)] + [(None, URLS[5], None), (5, URLS[5], "")], "page_id long, url string, html string")
    pages = pages.withColumns({c: F.lit("extra") for c in CLASHING})
    got = urls.judge(pages).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, verdict, rule = plain_url(r.row.url)
        assert (r.host, r.path, r.rule) == (host, path, rule), r.row.url
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
        assert r.row.verdict == "extra"
    assert urls.judge(pages.limit(0)).collect() == []
    none = urls.judge(pages, rules=()).collect()
    assert {r.verdict for r in none} == {"allow"} and {r.rule for r in none} == {None}


def test_entropy_and_counts(spark):
    row = spark.range(1).select(*(c.alias(k) for k, c in urls.lexical(F.lit("http://a-b.x.org/p/12?q=1&r=2#f")).items())).first()
    text = "http://a-b.x.org/p/12?q=1&r=2#f"
    want = -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())
    assert abs(row.entropy - want) < 1e-9 and (row.depth, row.parameters, row.hyphens, row.host_labels, row.fragment) == (2, 2, 1, 3, 1)
    assert abs(row.digit_ratio - 4 / len(text)) < 1e-9


def test_trees_learn_labelled_urls_and_hold_on_others(spark):
    rnd = random.Random(4)

    def url(bad):
        name = "".join(rnd.choices("abcdefgh0123456789" if bad else "abcdefgh", k=14 if bad else 8))
        return f"http://{name}.{'xyz' if bad else 'org'}/{'a/' * rnd.randint(0, 3)}{'?a=1&b=2&c=3' if bad else ''}"

    known = [(url(i % 2 == 0), i % 2 == 0) for i in range(600)]
    fresh = [(i, url(i % 2 == 0)) for i in range(300)]
    labelled = spark.createDataFrame([*known, (None, True), ("http://x", None)], "url string, blocked boolean")
    got = urls.judge(spark.createDataFrame(fresh, "page_id long, url string"), rules=(), labelled=labelled).collect()
    assert sum((r.verdict == "block") == (r.row.page_id % 2 == 0) for r in got) >= 285


def test_trees_as_expressions_equal_the_model(spark):
    from pyspark.ml.feature import VectorAssembler

    rnd = random.Random(5)
    rows = [(rnd.random(), rnd.choice([0.0, 1.0, 2.0]), rnd.random()) for _ in range(400)]
    df = spark.createDataFrame([(*r, float(r[0] + r[1] > 1.2)) for r in rows], "x double, y double, z double, label double").coalesce(1)
    model = trees.fit(df, ["x", "y", "z"], "label", 6, 3)
    scored = model.transform(VectorAssembler(inputCols=["x", "y", "z"], outputCol="_features").transform(df))
    both = scored.select(trees.probability(model, lambda i: F.col("xyz"[i])).alias("own"), "probability").collect()
    assert all(abs(r.own - r.probability[1]) < 1e-9 for r in both)


# ---- personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_valid(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d)))
        return 14 <= len(d) <= 19 and total % 10 == 0
    return {"email": True, "ip": all(int(p) <= 255 for p in s.split(".")) if kind == "ip" else True, "phone": 10 <= len(d) <= 15}[kind]


def plain_spans(text):
    found = [(m.start(), i, m.end()) for i, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if plain_valid(k, m[0])]
    return sorted(found)


def private_texts(seed=7):
    rnd = random.Random(seed)
    parts = [
        "a.b@c.d", "x@y", "a@b.c%x@d.e", "é@f.com", "me@mail-1.example.com.", "@a.b", "1.2.3.4", "256.1.1.1", "0001.2.3.4", "1.2.3.4.5.6.7.8", "1.2.3",
        "4532015112830366", "4532-0151-1283-0366", "4532 0151 1283 0367", "+1 (212) 555-0100", "+1 (212) 555-0100 4532015112830366", "+12 34", "++491512345678", "+1" + "2" * 20,
        "9" * 300, "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5", "--", "日本", "tel", "🙂", "ab1234567890123456cd", "1" * 25 + ".2.3.4", "\n", "(", ")", ",", "0" * 16,
    ]
    texts = [" ".join(rnd.choices(parts, k=rnd.randint(0, 12))) for _ in range(250)]
    texts += ["".join(rnd.choices(parts, k=rnd.randint(0, 12))) for _ in range(250)]
    return [*texts, None, "", "a" * 60_000, "1" * 60_000, "1." * 20_000, " ".join(["1.2.3.4 é a@b.cd"] * 700), texts[3], texts[3]]


def base_of(spark, texts):
    docs = frame(spark, [(i, t, "s") for i, t in enumerate(texts)])
    return docs, pii.find(docs, pii.Judge(None, {}))


def test_base_spans_equal_plain_patterns(spark):
    texts = private_texts()
    _, found = base_of(spark, texts)
    for r in found.select("row.doc_id", "base", pii.printed(F.col("base")).alias("printed")).collect():
        want = plain_spans(texts[r.doc_id])
        assert [(s.start, s.kind, s.end) for s in r.base] == want, texts[r.doc_id][:200]
        assert r.printed == ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want)


def test_redaction_removes_every_span_and_nothing_else(spark):
    texts = private_texts(8)
    _, found = base_of(spark, texts)
    found = found.select("row.doc_id", F.col("row.text").alias("old"), "base")
    for r in pii.redacted(found, "old", "base", "text").collect():
        out, at, text = "", 0, texts[r.doc_id]
        for a, k, b in plain_spans(text):
            if a >= at:
                out += text[at:a] + f"[{pii.KINDS[k].upper()}]"
            at = max(at, b)
        assert r.text == (None if text is None else out + text[at:])


def test_candidates_recover_spans_that_the_base_loses(spark):
    rnd = random.Random(9)

    def card():
        body = "4" + "".join(rnd.choices("0123456789", k=14))
        return next(body + c for c in "0123456789" if plain_valid("card", body + c))

    def phone():
        return f"+1 ({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}"

    def bad():
        return "".join(rnd.choices("0123456789abcdef", k=6)) + "".join(rnd.choices("0123456789", k=17)) + "ab"

    rows = [(i, f"some words {card()} here, or {phone()} and {bad()} token, {rnd.randint(1, 200)}.2.3.{rnd.randint(1, 99)}", "s") for i in range(900)]
    lost = [(1000 + i, f"call {phone()} {card()} now", "s") for i in range(20)]
    docs = frame(spark, rows + lost)
    found = {r.row.doc_id: r for r in pii.find(docs, pii.train(docs)).collect()}
    for i, text, _ in lost:
        assert found[i].base == [] and {pii.KINDS[s.kind] for s in found[i].added} == {"phone", "card"}
        assert re.fullmatch(r"call \+1 .{14} \d{16} now", text)
        assert sorted((s.start, s.end) for s in found[i].added) == [(5, 22), (23, 39)]
    assert sum(len(found[i].added) for i, *_ in rows) <= 5  # hexadecimal tokens are left alone


def test_forms_that_the_base_never_matches_are_learnt(spark):
    """Emails written out and phones without their country, never labelled as
    such, are found; sentences written like emails are left alone."""
    rnd = random.Random(10)
    word = lambda: "".join(rnd.choices("abcdefghij", k=rnd.randint(3, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, f"{prose(6)}. {prose(4)} mail {word()}.{word()}@{word()}.{word()}.com {prose(3)} or call +1 {rnd.randint(200, 999)} 555 {rnd.randint(1000, 9999)}, {prose(5)}.", "s") for i in range(800)]
    rows += [(2000 + i, f"{prose(20)}. {prose(9)}. build 12.34.5 of {rnd.randint(10**4, 10**6)} +{rnd.randint(10**16, 10**18)} parts", "s") for i in range(300)]
    forms = [
        lambda: ("email", f"{word()} (at) {word()} (dot) com"), lambda: ("email", f"{word()}[at]{word()}.com"),
        lambda: ("email", f"{word()}.{word()}(at){word()}(dot){word()}(dot)com"), lambda: ("phone", f"({rnd.randint(200, 999)}) 555-{rnd.randint(1000, 9999)}"),
        lambda: ("phone", f"{rnd.randint(200, 999)}-555-{rnd.randint(1000, 9999)}"), lambda: ("phone", f"{rnd.randint(200, 999)}.555.{rnd.randint(1000, 9999)}"),
    ]
    planted = {}
    for i in range(120):
        kind, form = forms[i % len(forms)]()
        text = f"{prose(5)} {'mail' if kind == 'email' else 'call'} {form} {prose(4)}."
        planted[5000 + i] = (kind, text.index(form), text.index(form) + len(form))
        rows.append((5000 + i, text, "s"))
    docs = frame(spark, rows)
    found = {r.row.doc_id: r for r in pii.find(docs, pii.train(docs)).collect()}
    hits = sum(any((pii.KINDS[s.kind], s.start, s.end) == want for s in found[i].added) for i, want in planted.items())
    assert hits >= 0.9 * len(planted)
    others = [s for i, r in found.items() if i not in planted for s in r.added]
    assert len(others) <= 0.03 * hits


def test_rare_kinds_are_chosen_from_all_documents(spark):
    """Documents with a kind are looked for in the whole table, not in a sample of it."""
    rows = [(i, "plain words only. nothing else", "s") for i in range(3000)]
    name = random.Random(3)
    rows += [(9000 + i, f"write to {''.join(name.choices('abcdefg', k=7))}@mail.example.com now or later please. thanks all", "s") for i in range(120)]
    rows += [(9500, "write to someone (at) mail (dot) example (dot) com now", "s")]
    docs = frame(spark, rows)
    judge = pii.train(docs, max_docs=400)
    assert pii.KINDS.index("email") in judge.thresholds
    added = {r.row.doc_id: r.added for r in pii.find(docs, judge).collect() if r.added}
    assert [(s.start, s.end) for s in added[9500]] == [(9, 50)]


def test_personal_data_in_empty_tables(spark):
    empty = frame(spark, [])
    judge = pii.train(empty)
    assert judge.model is None and pii.find(empty, judge).collect() == []


# ---- shared parts, queries, pipeline


def test_components_of_chains_hubs_and_loops(spark):
    rnd = random.Random(2)
    chain = rnd.sample(range(1000, 5000), 400)
    edges = [*zip(chain, chain[1:]), *((7, 10_000 + i) for i in range(500)), (3, 3), (20, 21), (21, 22), (22, 20), (21, 20)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    want = {i: min(chain) for i in chain} | {7: 7} | {10_000 + i: 7 for i in range(500)} | {20: 20, 21: 20, 22: 20}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), "test").collect() == []


@pytest.mark.parametrize("name", sorted(queries.llm_oracle()))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    found = queries.llm_queries()[name](spark, SMALL)
    want = con.execute(queries.llm_oracle()[name])
    order = sorted(found.columns)
    names = [d[0] for d in want.description]
    assert order == sorted(names)
    rows = Counter(tuple(r[names.index(c)] for c in order) for r in want.fetchall())
    assert Counter(tuple(r[c] for c in order) for r in found.collect()) == rows


def first_of_near_duplicates(texts, percent):
    """The smallest ids of the groups that all pairs with a shared shingle give."""
    sets, holders, parent = {}, {}, {i: i for i in texts}
    for i, text in texts.items():
        found = (text or "").encode().lower().split()
        sets[i] = {tuple(found[j : j + 5]) for j in range(max(len(found) - 4, 1))} if found else set()
        for shingle in sets[i]:
            holders.setdefault(shingle, []).append(i)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in {(a, b) for ids in holders.values() for k, b in enumerate(ids) for a in ids[:k]}:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i for i in texts if root(i) == i}


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_duplicates", "pii", "mixing", "packing"]
    kept = {r.doc_id: r.text for r in docs.collect()}

    first = stages["toxicity"](spark, docs, SF)
    assert first.columns == docs.columns and first.dtypes == docs.dtypes
    model = toxicity.train(docs, table(spark, SF, "labels"))
    clean = {r.doc_id for r in first.select("doc_id").collect()}
    for doc_id, text in kept.items():
        score = model.score(text)
        assert (doc_id in clean) == (score < 0.5) or abs(score - 0.5) < 1e-6

    second = stages["near_duplicates"](spark, docs, SF)
    assert second.columns == docs.columns
    assert {r.doc_id for r in second.collect()} == first_of_near_duplicates(kept, 80)

    third = {r.doc_id: r for r in stages["pii"](spark, docs, SF).collect()}
    assert set(third) == set(kept)
    for doc_id, text in kept.items():
        if not plain_spans(text) and third[doc_id].text != text:
            assert "[" in third[doc_id].text  # an added span
        assert not any(e in (third[doc_id].text or "") for e in re.findall(PLAIN["email"].replace("(", "(?:"), text or ""))
        assert third[doc_id].n_chars == len(third[doc_id].text)

    fourth = stages["mixing"](spark, docs, SF)
    assert fourth.columns == docs.columns and 800 < fourth.count() < 1200
    last = stages["packing"](spark, docs.limit(50), SF)
    assert {r.doc_id for r in last.select("doc_id").collect()} <= set(kept)


def test_pipeline_handles_odd_rows(spark):
    odd = [(None, None, None), (1, None, "src0"), (2, "", None), (3, "word " * 3000, "src1"), (3, "word " * 3000, "src1"), (4, "a@b.com", "src2")]
    for rows in ([], odd):
        docs = frame(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            out.collect()
            if name != "packing":
                assert out.columns == docs.columns


def test_pipeline_keeps_one_of_equal_rows(spark):
    """Rows that repeat an id and a text, and rows without an id, are
    compared like all others; rows of one id and other texts stay."""
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(9, words), (9, words), (None, words), (4, words + " end"), (None, "alone here"), (None, "alone here"), (7, "x y z"), (7, "a b c")]
    left = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, frame(spark, [(i, t, "s") for i, t in rows]), SMALL)
    got = Counter((r.doc_id, r.text) for r in left.collect())
    assert got == Counter([(4, words + " end"), (None, "alone here"), (7, "x y z"), (7, "a b c")])


def test_labelled_texts_are_those_of_the_labels(spark):
    """The bit map lets more rows pass, the join none."""
    rows = [(i, f"text {i}", "s") for i in range(3000)] + [(None, "none", "s"), (5, "again", "s")]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(0, 6000, 3)] + [(None, 1, 1), (6, 1, 1)], LABELS)
    found = toxicity.labelled(frame(spark, rows), labels, "doc_id", "text", "toxic").collect()
    chosen = {i: i % 2 for i in range(0, 6000, 3)} | {6: 1}
    want = Counter((i, t, bool(chosen[i])) for i, t, _ in rows if i in chosen and zlib.crc32(str(i).encode()) % 5)
    assert Counter((r.doc_id, r.text, r.toxic) for r in found) == want


def test_the_rest_works_without_this_subpackage(tmp_path):
    root = Path(corpus_pipeline.__file__).parent
    for name in ("retailflow", "__spark_entry__.py"):
        (tmp_path / name).mkdir() if name == "retailflow" else (tmp_path / name).symlink_to(root / name)
    for p in (root / "retailflow").iterdir():
        if p.name != "llm":
            (tmp_path / "retailflow" / p.name).symlink_to(p)
    code = "import json, __spark_entry__ as e; print(json.dumps(sorted(e.queries())))"
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "HOME": str(tmp_path)})
    assert out.returncode == 0, out.stderr
    names = json.loads(out.stdout.splitlines()[-1])
    assert "sales_by_category" in names and not any(n.startswith("op") and n[2].isdigit() for n in names) and "pipeline" not in names
    entry = importlib.import_module("__spark_entry__")
    assert {f"op{i}" for i in range(1, 11)} <= {n.split("_")[0] for n in entry.queries()} and "pipeline" in entry.queries()


def test_pipeline_drops_near_duplicates_from_080(spark):
    """Copies of similarity 0.83 and 0.77: only the first goes."""
    words = [[f"{c}{i}" for i in range(104)] for c in "vw"]
    texts = [words[0], words[0][16:] + ["x"], words[1], words[1][22:] + ["x"]]
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    near, far = (len(a & b) / len(a | b) for a, b in (sets[:2], sets[2:]))
    assert far < 0.8 < near < 0.85
    docs = frame(spark, [(i, " ".join(t), "src0") for i, t in enumerate(texts)])
    left = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SMALL)
    assert sorted(r.doc_id for r in left.collect()) == [0, 2, 3]


def test_class_counts_use_all_training_labels(spark):
    """The bound on labelled documents holds for the curve alone."""
    rows, labels = speech(400)
    docs, labels = frame(spark, rows), spark.createDataFrame(labels, LABELS)
    few, every = (toxicity.train(docs, labels, max_labelled=n) for n in (40, 10_000))
    assert every.ids and few.ids == every.ids and (few.table == every.table).all()


def test_every_word_with_evidence_is_in_the_vocabulary(spark):
    """More than 1024 words tell the classes apart, and all are kept."""
    letters = "abcdefghijklmnop"
    words = [f"{a}{b}{c}" for a in letters for b in letters for c in letters[:9]]
    both = [words[:1152], words[1152:]]
    rows = [(i, " ".join(both[i % 2]), "s") for i in range(200)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], LABELS)
    model = toxicity.train(frame(spark, rows), labels)
    assert set(model.ids) == set(words)
    assert [model.score(" ".join(w[-3:])) > 0.5 for w in both] == [False, True]


def test_pairs_and_words_give_the_differences_of_the_whole_table():
    size, rnd = 9, np.random.default_rng(3)
    counts = rnd.integers(0, 3, (2, size, size)) * rnd.integers(0, 2, (2, size, size))
    counts[:, 4] = 0
    shared = np.full(size, 1 / size)
    at = np.nonzero(counts)
    found = dict(zip(("kind", "previous", "word"), at)) | {"n": counts[at]}
    model = toxicity.Model({}, *toxicity.pair_differences(found, shared), 1.0, 0.0)
    want = toxicity.log_probabilities(counts[1].astype(float), shared) - toxicity.log_probabilities(counts[0].astype(float), shared)
    previous, word = (x.ravel() for x in np.indices((size, size)))
    assert np.allclose(model.differences(previous, word), want.ravel(), atol=1e-5)


def test_the_curve_is_fitted_to_all_its_labels(spark):
    """Beyond any bound: the curve of rows that are there twice is that of the rows."""
    x, y = np.array([-1.0, -0.5, 0.1, 0.4, 2.0]), np.array([0.0, 1.0, 0.0, 1.0, 1.0])
    assert np.allclose(toxicity.curve(x, y, np.array([3, 1, 2, 2, 1])), toxicity.curve(np.repeat(x, [3, 1, 2, 2, 1]), np.repeat(y, [3, 1, 2, 2, 1]), np.ones(9)))
    rows, labels = speech(400)
    docs, labels = frame(spark, rows), spark.createDataFrame(labels, LABELS)
    few, every = (toxicity.train(docs, labels, max_labelled=n) for n in (8, None))
    assert (few.slope, few.shift) != (every.slope, every.shift)


def test_personal_data_is_learnt_from_every_document(spark, monkeypatch):
    """All candidates of all documents are examples, also beyond 5,000 documents of a kind and without an id."""
    seen = {}
    monkeypatch.setattr(pii, "fit", lambda rows, *a, **k: seen.update(n=rows.selectExpr("sum(n)").first()[0]) or trees.fit(rows, *a, **k))
    rows = [(i if i % 3 else None, f"from 10.{i % 200}.{i // 200}.7 or 999.{i}.1.1", "s") for i in range(6000)]
    examples = {}
    written = pii.written
    monkeypatch.setattr(pii, "written", lambda df, label: examples.setdefault(label, written(df, label)))
    pii.train(frame(spark, rows))
    n = examples["pii-examples"].groupBy("label").agg(F.sum("n").alias("n")).collect()
    assert {r.label: r.n for r in n if r.label == 1} == {1: 6000}
    assert 0 < seen["n"] < sum(r.n for r in n)
