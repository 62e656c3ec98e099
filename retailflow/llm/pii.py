"""Personal data: base patterns, and further spans by boosted candidates.

Base spans are the matches of four patterns that pass their check (parts of
an ip, digits and Luhn sum of a card, digits of a phone). A base match that
swallows its neighbour fails its check and is lost, as when a card follows a
phone. High-recall generators therefore propose further, overlapping spans;
boosted trees judge each by its format and context, and the spans whose
probability reaches their kind's threshold are added where they overlap
nothing that is there already, the likelier one first.

Learning: a candidate that is a base span of its kind is an example for, a
candidate that could not be valid by itself an example against; those that
could be valid but are no base span are what the model decides. Forms that
the base never matches are learnt from base spans rewritten into them, in
their own context: emails written out ("name (at) host (dot) com") and phones
without their country ("(212) 555-0100"); the end of a sentence written like
an email is an example against. Such forms found as they are in a text have no
label. Thresholds are the lowest at which held-back examples of the kind
reach PRECISION.

Examples come from all documents; equal ones are added up, so that what the
trees learn from grows with the different examples. All other steps are column
expressions over whole texts: pieces between matches
give positions, arrays of structs carry candidates, and the trees are CASE
expressions inside them. Rows are judged where they are read: no shuffle.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import written
from retailflow.llm.trees import fit, probability

KINDS = ("email", "ip", "card", "phone")

# The base patterns. Runs are possessive and begin only where a
# run begins (or where the last match ended), which finds the same matches
# without trying every character of a long run.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Substrings without which a text has no match.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}

#: High-recall generators: (kind, pattern). Spans of several may overlap.
GENERATORS = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?\(dot\)\x20?|\x20?\[dot\]\x20?)[A-Za-z0-9-]++)++"),
    ("ip", r"(?<![0-9.])[0-9]{1,4}+(?:\.[0-9]{1,4}+){3}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{12,20}+(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}[\x20-][0-9]{4,6}[\x20-][0-9]{4,5}(?:[\x20-][0-9]{4})?(?![0-9])"),
    ("phone", r"\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{4}(?![0-9])"),
    ("phone", r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
)
#: What a document with a labelled candidate or a base span of a kind holds: enough to find those to learn from among all.
LIKELY = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
#: Characters of context on each side.
CONTEXT = 24
#: Words that announce personal data, looked for in the context before.
ANNOUNCED = r"(?i)\b(?:e-?mail|mail|tel|phone|call|fax|mobile|card|visa|ip|host|address|contact)\b"

#: Files that the examples, equal ones added up, are spread over.
EXAMPLE_FILES = 8
ROUNDS, DEPTH = 20, 3
PRECISION = 0.97
#: Held-back examples for that a threshold must rest on.
LEAST_EXAMPLES = 20

FEATURES = (
    "kind", "length", "digits", "letters", "separators", "groups", "longest_group", "plus", "brackets", "dots",
    "before_alnum", "after_alnum", "before_space", "after_space", "announced",
)


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn sum."""
    each = F.transform(F.split(F.reverse(number), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    doubled = F.transform(each, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def valid(kind: str, x: Column) -> Column:
    """The check of a base match."""
    n = F.length(digits(x))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(x, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")).between(0, 3) & (F.coalesce(p.try_cast("decimal(38,0)"), F.lit(999)) <= 255))
    return n.between(14, 19) & luhn(digits(x)) if kind == "card" else n.between(10, 15)


def matches(text: Column, pattern: str, needs: str = "") -> Column:
    """The non-overlapping matches ``found`` and the ``gaps`` around them."""
    has = F.instr(text, needs) > 0 if needs else F.lit(True)
    found = F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    gaps = F.when(F.size(found) > 0, F.split(text, pattern, -1))
    return F.struct(found.alias("found"), gaps.alias("gaps"))


#: Elements that a running value is summed up over in one go.
_CHUNK = 128


def running(docs: DataFrame, names: dict[str, str], op) -> DataFrame:
    """``docs`` with, for each ``source: target``, the running ``op`` (from 0)
    before each element of the integer array ``source``. Whole chunks come
    first, so an array of n elements costs n x _CHUNK steps and not n x n.
    Each array is a column that later steps refer to more than once, which
    keeps the optimiser from computing it anew for every element."""

    def folded(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), op)

    def chunks(source: str) -> Column:
        def step(sums: Column, c: Column) -> Column:
            return F.concat(sums, F.array(op(F.element_at(sums, -1), folded(F.slice(source, c * _CHUNK + 1, _CHUNK)))))

        every = F.sequence(F.lit(0), F.floor(F.size(source) / _CHUNK).cast("int"))
        return F.aggregate(every, F.array(F.lit(0)), step)

    def before(source: str) -> Column:
        def one(_: Column, i: Column) -> Column:
            rest = F.slice(source, (i - i % _CHUNK + 1).cast("int"), (i % _CHUNK).cast("int"))
            return op(F.get(f"_chunks_{source}", F.floor(i / _CHUNK).cast("int")), folded(rest))

        return F.when(F.size(f"_chunks_{source}") > 0, F.transform(source, one))

    docs = docs.withColumns({f"_chunks_{s}": chunks(s) for s in names})
    return docs.withColumns({t: before(s) for s, t in names.items()}).drop(*(f"_chunks_{s}" for s in names))


def located(docs: DataFrame, text: Column, patterns: dict[str, tuple[str, str]]) -> DataFrame:
    """``docs`` with, for each ``name: (pattern, needed substring)``, an array
    of {start, end, found, before, after} in code points; ``before`` and
    ``after`` are up to CONTEXT characters of the gaps on either side."""
    docs = docs.withColumns({f"_m_{n}": matches(text, *p) for n, p in patterns.items()})

    def lengths(name: str) -> Column:
        return F.transform(f"_m_{name}.found", lambda x, i: F.length(F.get(f"_m_{name}.gaps", i)) + F.length(x))

    def spans(name: str) -> Column:
        gaps = F.col(f"_m_{name}.gaps")

        def one(z: Column, i: Column) -> Column:
            start = z.at + F.length(F.get(gaps, i))
            return F.struct(
                start.alias("start"),
                (start + F.length(z.found)).alias("end"),
                z.found.alias("found"),
                F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"),
                F.left(F.get(gaps, i + 1), F.lit(CONTEXT)).alias("after"),
            )

        zipped = F.arrays_zip(F.col(f"_m_{name}.found").alias("found"), F.col(f"_at_{name}").alias("at"))
        return F.coalesce(F.transform(zipped, one), F.array())

    docs = docs.withColumns({f"_l_{n}": lengths(n) for n in patterns})
    docs = running(docs, {f"_l_{n}": f"_at_{n}" for n in patterns}, lambda a, x: a + x)
    return docs.withColumns({n: spans(n) for n in patterns}).drop(*(f"_{x}_{n}" for x in ("m", "l", "at") for n in patterns))


def _features(kind: int, x: Column) -> list[Column]:
    """FEATURES of a candidate. None of them is the check itself, nor whether
    there are digits nearby: that is how the base loses a span."""
    s = x.found
    groups = F.split(s, "[^0-9]+")

    def flag(c: Column) -> Column:
        return c.cast("double")

    return [
        F.lit(float(kind)),
        F.length(s).cast("double"),
        F.length(digits(s)).cast("double"),
        F.length(F.regexp_replace(s, "[^A-Za-z]", "")).cast("double"),
        F.length(F.regexp_replace(s, r"[^\x20()\[\].-]", "")).cast("double"),
        F.size(groups).cast("double"),
        F.array_max(F.transform(groups, F.length)).cast("double"),
        flag(F.startswith(s, F.lit("+"))),
        flag(s.rlike(r"[(\[]")),
        F.length(F.regexp_replace(s, r"[^.]", "")).cast("double"),
        flag(x.before.rlike("[A-Za-z0-9]$")),
        flag(x.after.rlike("^[A-Za-z0-9]")),
        flag((F.length(x.before) == 0) | x.before.rlike(r"\s$")),
        flag((F.length(x.after) == 0) | x.after.rlike(r"^[\s.,;!?]")),
        flag(x.before.rlike(ANNOUNCED)),
    ]


def base_spans(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``_base``: the valid matches as a sorted array of {start,
    kind (its number), end}."""
    body = F.coalesce(F.col(text), F.lit(""))
    docs = located(docs, body, {f"_s_{k}": (BASE[k], NEEDS[k]) for k in KINDS})

    def checked(kind: str) -> Column:
        number = F.lit(KINDS.index(kind)).alias("kind")
        passing = F.filter(f"_s_{kind}", lambda x: valid(kind, x.found))
        return F.transform(passing, lambda x: F.struct(x.start.alias("start"), number, x.end.alias("end")))

    return docs.withColumn("_base", F.array_sort(F.concat(*map(checked, KINDS)))).drop(*(f"_s_{k}" for k in KINDS))


def candidates(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` (with ``_base``) with ``_candidates``: array of {start, kind,
    end, found, features, base (is it a base span), clear (overlaps none)}."""
    body = F.coalesce(F.col(text), F.lit(""))
    docs = located(docs, body, {f"_g_{i}": (p, "") for i, (_, p) in enumerate(GENERATORS)})

    def proposed(i: int, kind: str) -> Column:
        number = KINDS.index(kind)

        def one(x: Column) -> Column:
            return F.struct(
                x.start.alias("start"),
                F.lit(number).alias("kind"),
                x.end.alias("end"),
                x.found.alias("found"),
                F.array(*_features(number, x)).alias("features"),
                F.exists("_base", lambda b: (b.start == x.start) & (b.end == x.end) & (b.kind == number)).alias("base"),
                (~F.exists("_base", lambda b: (b.start < x.end) & (x.start < b.end))).alias("clear"),
            )

        return F.transform(f"_g_{i}", one)

    every = F.concat(*(proposed(i, kind) for i, (kind, _) in enumerate(GENERATORS)))
    return docs.withColumn("_candidates", every).drop(*(f"_g_{i}" for i in range(len(GENERATORS))))


class Judge:
    """Trained trees and one threshold per kind; ``model`` is None where there
    was nothing to learn from, and then no candidate is added."""

    def __init__(self, model, thresholds: dict[int, float]):
        self.model, self.thresholds = model, thresholds

    def chance(self, features: Column) -> Column:
        return probability(self.model, lambda i: F.get(features, F.lit(i)))

    def least(self, kind: Column) -> Column:
        out = F.lit(2.0)
        for number, threshold in self.thresholds.items():
            out = F.when(kind == number, threshold).otherwise(out)
        return out


def rewritten(docs: DataFrame) -> DataFrame:
    """``docs`` (_id, _text, _base) -> short texts ``_text`` that hold a form
    from ``_from`` to ``_to`` which is (``_label`` 1) or is not one of
    ``_kind``."""
    email, phone = KINDS.index("email"), KINDS.index("phone")
    spans = docs.select("_id", "_text", F.explode("_base").alias("s")).where(F.col("s.kind").isin(email, phone))
    found = F.expr("substring(_text, s.start + 1, s.end - s.start)")
    name, place, number = F.substring_index(found, "@", 1), F.substring_index(found, "@", -1), F.right(digits(found), F.lit(10))

    def dots(by: str) -> Column:
        return F.regexp_replace(place, r"\.", by)

    area, middle, last = (F.substring(number, i, n) for i, n in ((1, 3), (4, 3), (7, 4)))
    emails = (
        F.concat(name, F.lit(" (at) "), dots(" (dot) ")), F.concat(name, F.lit("[at]"), place),
        F.concat(name, F.lit(" (at) "), place), F.concat(name, F.lit("(at)"), dots("(dot)")),
    )
    phones = (
        F.concat(F.lit("("), area, F.lit(") "), middle, F.lit("-"), last),
        *(F.concat_ws(by, area, middle, last) for by in ("-", ".", " ")),
    )
    form = F.when(F.col("s.kind") == email, F.array(*emails)).otherwise(F.array(*phones))
    examples = spans.select(
        "_id", F.expr(f"right(left(_text, s.start), {CONTEXT})").alias("before"),
        F.get(form, F.pmod(F.xxhash64("_id", "s.start"), F.lit(4)).cast("int")).alias("form"),
        F.expr(f"substring(_text, s.end + 1, {CONTEXT})").alias("after"), F.col("s.kind").alias("_kind"), F.lit(1).alias("_label"),
    )
    sentence = rf"(?s)(.{{0,{CONTEXT}}})\b([A-Za-z]{{2,}})\x20([A-Za-z]{{2,}}\.)\s([A-Za-z]{{2,}})(.{{0,{CONTEXT}}})"
    part = [F.regexp_extract("_text", sentence, i) for i in range(1, 6)]
    against = docs.where(F.col("_text").rlike(sentence)).select(
        "_id", part[0].alias("before"), F.concat(part[1], F.lit(" (at) "), part[2], part[3]).alias("form"),
        part[4].alias("after"), F.lit(email).alias("_kind"), F.lit(0).alias("_label"),
    )
    start = F.length("before")
    return examples.unionByName(against).select(
        "_id", F.concat("before", "form", "after").alias("_text"), start.alias("_from"), (start + F.length("form")).alias("_to"), "_kind", "_label"
    )


def train(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_docs: int | None = None, precision: float = PRECISION,
    rounds: int = ROUNDS,
) -> Judge:
    """Trees and thresholds from the candidates of all documents that may hold
    one (of at most ``max_docs``, picked for each kind by the hash of their
    ids, if given). Candidates of equal features are learnt from as one with
    their number as its weight. A document without an id goes by its text."""
    own_id = F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(text))
    ids = docs.select(own_id.alias("_id"), F.col(text).alias("_text"))
    likely = [F.col("_text").rlike(pattern) for pattern in LIKELY.values()]
    some = ids.where(reduce(or_, likely))
    if max_docs is not None:
        chosen = None
        for kind, has in zip(LIKELY, likely):
            own = ids.where(has).select("_id").distinct()
            own = own.orderBy(F.xxhash64("_id", F.lit(kind)), "_id").limit(max_docs // len(KINDS))
            chosen = own if chosen is None else chosen.union(own)
        some = some.join(F.broadcast(written(chosen.distinct(), "pii-chosen")), "_id")
    some = written(base_spans(some, "_text"), "pii-likely")
    # explode() would have its "is there any" filter, with all that it rests on, moved below what comes before.
    found = candidates(some, "_text").select("_id", F.explode_outer("_candidates").alias("c")).where("c is not null")
    # A candidate that is valid by itself but no base span is left for the model to decide, as are the forms that are rewritten.
    label = F.when(F.col("c.base"), 1)
    for i, kind in enumerate(KINDS):
        label = label.when((F.col("c.kind") == i) & F.col("c.found").rlike(f"^(?:{BASE[kind]})$") & valid(kind, F.col("c.found")), None)
    national = (F.col("c.kind") == KINDS.index("phone")) & ~F.startswith("c.found", F.lit("+"))
    label = label.when((F.col("c.kind") == KINDS.index("email")) | national, None).otherwise(0)
    forms = candidates(base_spans(written(rewritten(some), "pii-forms"), "_text"), "_text")
    forms = forms.select("_id", "_from", "_to", "_kind", "_label", F.explode_outer("_candidates").alias("c"))
    forms = forms.where("c.start = _from and c.end = _to and c.kind = _kind").select("_id", "c", F.col("_label").alias("label"))
    found = found.select("_id", "c", label.alias("label")).where("label is not null").union(forms)
    held = (F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(4)) == 0).alias("held")
    columns = ["label", "kind", *(f for f in FEATURES if f != "kind"), "held"]
    examples = written(
        found.select("label", "c.kind", held, *(F.col("c.features")[i].alias(f) for i, f in enumerate(FEATURES) if f != "kind"))
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n"))
        .repartition(EXAMPLE_FILES, *columns)
        .sortWithinPartitions(*columns),
        "pii-examples",
    )
    counts = {r.label: r["count"] for r in examples.where("not held").groupBy("label").count().collect()}
    if len(counts) < 2:
        return Judge(None, {})
    model = fit(examples.where("not held").withColumn("kind", F.col("kind").cast("double")), list(FEATURES), "label", rounds, DEPTH, weight="n")
    chance = probability(model, lambda i: F.col(FEATURES[i]).cast("double"))
    held = examples.where("held").select("kind", "label", "n", F.round(chance, 6).alias("chance"))
    rows = held.groupBy("kind", "chance").agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("n")).collect()  # of 6 decimals
    thresholds = {}
    for kind in range(len(KINDS)):
        right = n = 0
        for r in sorted((r for r in rows if r.kind == kind), key=lambda r: -r.chance):
            right, n = right + r.right, n + r.n
            if right >= LEAST_EXAMPLES and right >= precision * n:
                thresholds[kind] = r.chance
    return Judge(model, thresholds)


def find(docs: DataFrame, judge: Judge, text: str = "text") -> DataFrame:
    """``docs`` (all its columns as the struct ``row``) with ``base`` and
    ``added``: arrays of {start, kind, end} by start, then kind, in code
    points, end exclusive; kind is the number in KINDS.

    Null text is empty. Empty texts have no spans, repeated rows are judged
    each alike, an empty table gives no rows; no name of ``docs`` clashes.
    """
    docs = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(f"`{text}`").alias("_text"))
    docs = base_spans(docs, "_text")
    none = F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")
    if judge.model is None or not judge.thresholds:
        return docs.select("row", F.col("_base").alias("base"), none.alias("added"))
    docs = candidates(docs, "_text")
    docs = docs.withColumn(
        "_likely",
        F.array_sort(
            F.filter(
                F.transform(
                    F.filter("_candidates", lambda c: c.clear),
                    lambda c: F.struct(
                        (-F.round(judge.chance(c.features), 6)).alias("rank"), (c.start - c.end).alias("short"),
                        c.start.alias("start"), c.kind.alias("kind"), c.end.alias("end"),
                    ),
                ),
                lambda c: -c.rank >= judge.least(c.kind),
            )
        ),
    )
    added = F.aggregate(
        "_likely",
        none,
        lambda out, c: F.when(F.exists(out, lambda o: (o.start < c.end) & (c.start < o.end)), out).otherwise(
            F.concat(out, F.array(F.struct(c.start.alias("start"), c.kind.alias("kind"), c.end.alias("end"))))
        ),
    )
    return docs.select("row", F.col("_base").alias("base"), F.array_sort(added).alias("added"))


def printed(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start, s.end)), ",")


def redacted(docs: DataFrame, text: str, spans: str, out: str) -> DataFrame:
    """``docs`` with ``out``: the column ``text`` with each stretch of
    overlapping ``spans`` (sorted by start) replaced by the kind of its first
    span in brackets. Null text stays null."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    docs = docs.withColumn("_ends", F.transform(spans, lambda s: s.end))
    docs = running(docs, {"_ends": "_done"}, lambda a, x: F.greatest(a, x))
    heads = F.filter(F.arrays_zip(F.col(spans).alias("span"), F.col("_done").alias("done")), lambda z: z.span.start >= z.done)
    piece = F.transform(
        heads, lambda z: F.concat(F.substring(text, z.done + 1, z.span.start - z.done), F.get(names, z.span.kind))
    )
    rest = F.substring(text, F.array_max("_ends") + 1, F.length(text))
    whole = F.when(F.size("_ends") > 0, F.concat(F.array_join(piece, ""), rest)).otherwise(F.col(text))
    return docs.withColumn(out, whole).drop("_ends", "_done")
