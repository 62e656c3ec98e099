"""The registered queries' own columns against plain versions, and the score
of the language models against Kneser-Ney formulas written out."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from retailflow.llm import queries, toxicity, urls
from retailflow.llm.common import table
from test_llm_models import LABELS, SMALL, frame, plain_spans, plain_url, speech

BYTE_BPE, WORD_BPE = map(public_tokenizers.path, ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}


def test_op1_token_counts(spark, docs):
    tok = Tokenizer.from_file(BYTE_BPE)
    want = Counter()
    for i, t in docs.items():
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        want[i, len((t or "").encode()), n, n > 1024] += 1
    found = queries.op1_token_counts(spark, SMALL)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert Counter(map(tuple, found.collect())) == want and {k[3] for k in want} == {True, False}


def test_op2_packing(spark, docs):
    tok = Tokenizer.from_file(WORD_BPE)
    ids = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 2] for i, t in docs.items()}
    rows = queries.op2_packing(spark, SMALL).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.length == len(part) > 0 and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for i, parts in pieces.items():
        ends = [0, *(s + n for s, n in sorted(parts))]
        assert [s for s, _ in sorted(parts)] == ends[:-1] and ends[-1] == len(ids[i])
    padded = total = 0
    for parts in sequences.values():
        ends = [0, *(o + n for o, n in sorted(parts))]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 4096
        total += ends[-1]
        padded += 0 if ends[-1] & (ends[-1] - 1) == 0 else 4096 - ends[-1]
    assert padded <= 0.02 * total


def test_op5_toxicity(spark, docs):
    rows = {r.doc_id: r for r in queries.op5_toxicity(spark, SMALL).collect()}
    assert set(rows) == set(docs)
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_op7_url_filter(spark):
    pages = {r.page_id: r.url for r in table(spark, SMALL, "pages").collect()}
    rows = {r.page_id: r for r in queries.op7_url_filter(spark, SMALL).collect()}
    assert set(rows) == set(pages)
    for i, r in rows.items():
        host, path, verdict, rule = plain_url(pages[i])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.block_chance >= 0.5 else "allow"))


def test_op10_pii(spark, docs):
    kinds = ("email", "ip", "card", "phone")
    for r in queries.op10_pii(spark, SMALL).collect():
        base = plain_spans(docs[r.doc_id])
        counts = Counter(k for _, k, _ in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in range(4))
        printed = [f"{kinds[k]}:{s}:{e}" for s, k, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(printed).encode()).hexdigest()
        every = r.spans.split(",") if r.spans else []
        assert set(printed) <= set(every) and len(every) == len(base) + r.n_added
        order = [(int(s), kinds.index(k)) for k, s, _ in (x.split(":") for x in every)]
        assert order == sorted(order)


def plain_evidence(text, ids, corpus, labelled, discount=0.75):
    """Mean difference of log P(word | word before) between toxic and
    ordinary, by Kneser-Ney with the corpus's continuation kinds below."""

    def pairs(t):
        at = [1] + [ids.get(w, 0) for w in toxicity.words(t)]
        return list(zip(at, at[1:]))

    size = len(ids) + 2
    kinds = Counter(w for _, w in {p for t in corpus for p in pairs(t)})
    shared = {w: (kinds[w] + 1) / (sum(kinds.values()) + size) for w in range(size)}
    logs = []
    for side in (True, False):
        counts = Counter(p for t, toxic in labelled if toxic == side for p in pairs(t))
        own, after, followers = Counter(w for _, w in counts), Counter(), Counter()
        for (v, _), n in counts.items():
            after[v] += n
            followers[v] += 1
        total = max(sum(own.values()), 1)
        given = sum(max(n - discount, 0) for n in own.values()) / total

        def lower(w):
            return max(own[w] - discount, 0) / total + (1 - given) * shared[w]

        def chance(v, w):
            if not after[v]:
                return lower(w)
            kept = max(counts[v, w] - discount, 0) / after[v]
            return kept + discount * followers[v] / after[v] * lower(w)

        logs.append([math.log(chance(*p)) for p in pairs(text)])
    return sum(a - b for a, b in zip(*logs)) / len(logs[0]) if logs[0] else 0.0


def test_scores_equal_kneser_ney_written_out(spark):
    rows, labels = speech(300)
    rows += [(5000, "never seen words at all", "s"), (5001, None, "s"), (5002, "", "s"), (5003, "word " * 3000, "s")]
    docs = frame(spark, rows)
    model = toxicity.train(docs, spark.createDataFrame(labels, LABELS))
    sample = toxicity.labelled(docs, spark.createDataFrame(labels, LABELS), "doc_id", "text", "toxic")
    learnt = [(r.text, r.toxic) for r in sample.where("not curve").collect()]
    assert len(model.ids) >= 3 and {t for _, t in learnt} == {True, False}
    found = toxicity.score(docs, model, keep=["doc_id"], evidence=True).collect()
    texts, scores = {r[0]: r[1] for r in rows}, {r.row.doc_id: r.score for r in found}
    for i in [*list(texts)[:40], 5000, 5001, 5002, 5003]:
        want = plain_evidence(texts[i], model.ids, [r[1] for r in rows], learnt)
        assert abs(scores[i] - want) < 1e-5, i


def test_suffix_counts_cover_all_urls(spark, monkeypatch):
    """However few urls train the trees, suffixes are counted over all."""
    seen = {}

    def kept(df, label):
        seen[label] = df.collect()
        return spark.createDataFrame(seen[label], df.schema)

    monkeypatch.setattr(urls, "written", kept)
    pages = [(i, f"http://h{i}.{'net' if i % 2 else f's{i}'}/") for i in range(300)] + [(301, None), (302, "http://h1.net/")]
    labelled = [(u, i % 3 == 0) for i, u in pages[:200]] + [(None, True), ("http://z.other/", True)]
    urls.judge(
        spark.createDataFrame(pages, "page_id long, url string"), rules=(),
        labelled=spark.createDataFrame(labelled, "url string, blocked boolean"), max_labelled=10,
    ).collect()
    assert len(seen["url-sample"]) == 10 and len(seen["url-labels"]) == 202
    counts = {r["_suffix"]: (r["_n"], r["_b"], r["_l"]) for r in seen["url-suffixes"]}
    assert counts["net"] == (151, sum(i % 3 == 0 for i in range(1, 200, 2)), 100)
    assert counts["s0"] == (1, 1, 1) and counts["s298"] == (1, None, None) and counts["other"] == (None, 1, 1)
    assert len(counts) == 150 + 3
