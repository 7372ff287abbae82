"""Personal data by candidate gradient boosting, in DataFrame operations only.

Base rules find spans of four kinds, leftmost and without overlap for each kind; those
always stay. High-recall generators propose further spans, which overlap the base ones:
numbers inside longer runs that a rule drops, spelled-out addresses, numbers without a
plus sign. Boosted trees score each candidate by format and context. A candidate is added
where its score passes the kind's threshold, calibrated on another fold of the documents,
and no base span of its kind overlaps it.

The trees learn what the base rules cannot say. Of every base span, forms that the rules
miss are planted where it stands: spelled-out marks, other separators, no plus sign. They
are personal data. The same forms behind words that announce something else ("order",
"serial"), or with a digit changed so that the checksum or range fails, are not; nor are
candidates in the text itself of which either is true. Candidates equal to a base span
are personal data. All others are undecided and train nothing.

All rows, spans and features are handled by Spark's own expressions. What reaches the
driver is the count of candidates for each combination of feature values, whose number
is bounded by the features' ranges, not by the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rasterloom.llm.common import documents, materialize, text_of

KINDS = ("email", "ip", "card", "phone")
# The base rules; runs are possessive and begin where a run can begin, so that no text makes them slow or deep.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9]){13,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
GENERATORS = {
    "email": r"(?i)(?<![A-Z0-9._%+-])[A-Z0-9._%+-]{1,64}+(?:@| ?[\[({](?:at|@)[\])}] ?)[A-Z0-9-]{1,63}+(?:(?:\.| ?[\[({](?:dot|\.)[\])}] ?)[A-Z0-9-]{1,63}+){1,8}+|(?<![A-Z0-9._%+-])[A-Z0-9._%+-]{1,64}+ at [A-Z0-9-]{1,63}+(?: dot [A-Z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:(?:\.|\[\.\]|\(\.\))[0-9]{1,3}+){3}+(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}(?:[ ._/-]{0,2}+[0-9]{4}){3}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})(?![0-9])",
    "phone": r"\+[0-9]{1,3} ?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])|\+[0-9]{1,3}(?:[ .-][0-9]{2,4}){3,4}(?![0-9])|(?<![0-9+])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9.+-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9.-])",
}
#: What every match of the patterns above holds, so that a text without it need not be tried.
BASE_NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
NEEDS = {"email": r"@|(?i: at |[\[({]at[\])}])", "ip": r"[0-9](?:\.|\[\.\]|\(\.\))[0-9]", "card": r"[0-9]{4}", "phone": r"\+[0-9]|[0-9]{3}"}
CUES = r"(?i)mail|contact|write|address|server|host|card|visa|credit|pay|tel|phone|call|fax|mobile"
ANTI_CUES = r"(?i)token|key|hash|secret|version|serial|order|invoice|isbn|no\.|id[ :=]"
ROUNDS, RATE, LEAVES_LEAST = 40, 0.3, 10.0
#: What stands before a planted form that is not personal data.
DECOYS = (" order no. ", " serial ", " version ", " invoice ")
#: A threshold's least precision on the fold it is calibrated on, counting one error more.
PRECISION = 0.9


def _found(text: Column, pattern: str, needs: str) -> Column:
    """All matches with the length of the text before each, counted from the match before, and some characters around."""
    matched = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    around = F.transform(F.split(text, pattern, -1), lambda g: F.struct(F.length(g).alias("gap"), F.substring(g, -24, 24).alias("left"), F.substring(g, 1, 8).alias("right")))
    return F.when(text.rlike(needs) & text.rlike(pattern), F.struct(matched.alias("m"), around.alias("g")))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _valid(kind: Column, m: Column) -> Column:
    """The base rules' checks of a match."""
    part = F.transform(F.split(m, r"\."), lambda x: F.regexp_replace(x, "^0+", ""))
    ip = F.forall(part, lambda x: (F.length(x) <= 3) & (F.coalesce(x.try_cast("int"), F.lit(0)) <= 255))
    d = _digits(m)
    card = F.length(d).between(14, 19) & F.call_function("luhn_check", d)
    return F.when(kind == 0, True).when(kind == 1, ip).when(kind == 2, card).otherwise(F.length(d).between(10, 15))


def spans(found: DataFrame) -> DataFrame:
    """``found(rid, doc_id, b_<kind>, g_<kind>)`` -> ``rid, doc_id, kind, base, m, left, right, start, end`` in code points."""
    each = F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(side == "b").alias("base"), F.col(f"{side}_{name}").alias("f")) for k, name in enumerate(KINDS) for side in "bg"))
    rows = found.select("rid", "doc_id", F.explode(each).alias("x")).where("x.f IS NOT NULL").select("rid", "doc_id", "x.kind", "x.base", "x.f.m", "x.f.g")
    zipped = F.arrays_zip(F.col("m"), F.slice("g", F.lit(1), F.size("m")).alias("g"), F.slice("g", F.lit(2), F.size("m")).alias("n"))
    rows = rows.select("rid", "doc_id", "kind", "base", F.posexplode(zipped).alias("pos", "z"))
    rows = rows.select("rid", "doc_id", "kind", "base", "pos", F.col("z.m").alias("m"), F.col("z.g.gap").alias("gap"), F.col("z.g.left").alias("left"), F.col("z.n.right").alias("right"))
    # Positions add up along a document; its matches of one pattern, no more, are a window.
    upto = F.sum(F.col("gap") + F.length("m")).over(Window.partitionBy("rid", "kind", "base").orderBy("pos"))
    return rows.withColumn("end", upto.cast("long")).withColumn("start", F.col("end") - F.length("m")).drop("pos", "gap")


def features(c: DataFrame) -> DataFrame:
    """Small integers for format and context; spelled-out marks count as the marks themselves."""
    plain = F.regexp_replace(F.regexp_replace(F.col("m"), r"(?i) ?[\[({](?:at|@)[\])}] ?| at ", "@"), r"(?i) ?[\[({](?:dot|\.)[\])}] ?| dot ", ".")
    char = lambda x: F.when(F.length(x) == 0, 0).when(x.rlike(r"\s"), 1).when(x.rlike("[A-Za-z]"), 2).when(x.rlike("[0-9]"), 3).when(x.rlike("[.,;:!?]"), 4).otherwise(5)
    d = _digits(plain)
    octets = F.transform(F.split(plain, r"\."), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))
    tld = F.regexp_extract(plain, r"([A-Za-z]*)$", 1)
    return c.select(
        "*",
        F.least(F.length(d), F.lit(20)).alias("f_digits"),
        F.least(F.size(F.regexp_extract_all(plain, F.lit("[ ._/()-]"), F.lit(0))), F.lit(8)).alias("f_marks"),
        plain.startswith("+").cast("int").alias("f_plus"),
        F.when(F.col("kind") == 0, F.least(F.length(tld), F.lit(7))).otherwise(0).alias("f_tld"),
        F.when(F.col("kind") == 1, (F.array_max(octets) <= 255).cast("int")).when(F.col("kind") == 2, F.call_function("luhn_check", d).cast("int")).otherwise(1).alias("f_check"),
        char(F.substring("left", -1, 1)).alias("f_before"),
        char(F.substring("right", 1, 1)).alias("f_after"),
        F.when(F.col("left").rlike(ANTI_CUES), 0).when(F.col("left").rlike(CUES), 2).otherwise(1).alias("f_cue"),
    )


def planted(base: DataFrame) -> DataFrame:
    """Forms of valid base spans that the base rules miss, where those stand (``label`` 1) and as decoys (0): ``doc_id, kind, m, left, right, label``."""
    m, d = F.col("m"), _digits(F.col("m"))
    name, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    ten = [F.substring(d, at, n) for at, n in ((-10, 3), (-7, 3), (-4, 4))]
    fours = lambda mark: F.when(F.length(d) == 16, F.concat_ws(mark, *(F.substring(d, at, 4) for at in (1, 5, 9, 13))))
    forms = [
        F.array(F.concat(name, F.lit(" [at] "), F.replace(domain, F.lit("."), F.lit(" [dot] "))), F.concat(name, F.lit(" at "), F.replace(domain, F.lit("."), F.lit(" dot "))), F.concat(name, F.lit("(at)"), domain)),
        F.array(F.replace(m, F.lit("."), F.lit("[.]")), F.replace(m, F.lit("."), F.lit("(.)"))),
        F.array(fours("."), fours("/"), fours("_")),
        F.array(F.format_string("(%s) %s-%s", *ten), F.format_string("%s-%s-%s", *ten), F.format_string("%s.%s.%s", *ten)),
    ]
    which = lambda x: F.when(F.col("kind") == 0, x[0]).when(F.col("kind") == 1, x[1]).when(F.col("kind") == 2, x[2]).otherwise(x[3])
    broken = which([F.lit(None), F.concat(F.lit("9"), F.lit("99"), F.regexp_extract("f", r"^[0-9]+(.*)$", 1)), F.concat(F.regexp_extract("f", r"^(.*)[0-9]$", 1), ((F.substring("f", -1, 1).cast("int") + 1) % 10).cast("string")), F.lit(None)])
    rows = base.select("doc_id", "kind", "left", "right", F.posexplode(which(forms)).alias("k", "f")).where("f IS NOT NULL")
    decoy = F.element_at(F.array(*map(F.lit, DECOYS)), F.pmod(F.xxhash64("f"), F.lit(len(DECOYS))).cast("int") + 1)
    kinds = F.array(*(F.struct(a.alias("m"), b.alias("left"), F.lit(y).alias("label")) for a, b, y in ((F.col("f"), F.col("left"), 1), (F.col("f"), F.concat("left", decoy), 0), (broken, F.col("left"), 0))))
    rows = rows.select("doc_id", "kind", "right", F.explode(kinds).alias("x")).where("x.m IS NOT NULL")
    return rows.select("doc_id", "kind", "x.m", F.substring("x.left", -24, 24).alias("left"), "right", "x.label").where(which([F.col("m").rlike(f"^(?:{GENERATORS[k]})$") for k in KINDS]))


FEATURES = ("kind", "f_digits", "f_marks", "f_plus", "f_tld", "f_check", "f_before", "f_after", "f_cue")


@dataclass
class Trees:
    """Boosted trees of two levels; each is ``(feature, at most, (feature, at most, low, high) for either side)``."""

    first: float = 0.0
    trees: list = field(default_factory=list)
    thresholds: list = field(default_factory=lambda: [np.inf] * len(KINDS))

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.first)
        for f, cut, *sides in self.trees:
            for on, (g, c, low, high) in zip((x[:, f] <= cut, x[:, f] > cut), sides):
                out += on * np.where(x[:, g] <= c, low, high)
        return out

    def column(self) -> Column:
        """The same margin as an expression."""
        out = F.lit(self.first)
        side = lambda s: F.when(F.col(FEATURES[s[0]]) <= s[1], F.lit(float(s[2]))).otherwise(F.lit(float(s[3])))
        for f, cut, a, b in self.trees:
            out = out + F.when(F.col(FEATURES[f]) <= cut, side(a)).otherwise(side(b))
        return out


def boost(x: np.ndarray, ones: np.ndarray, total: np.ndarray) -> Trees:
    """Logistic gradient boosting over cells of equal features, ``ones`` of ``total`` candidates in each being positive."""
    t = Trees()
    if not total.sum():
        return t
    p0 = (ones.sum() + 1) / (total.sum() + 2)
    t.first = float(np.log(p0 / (1 - p0)))
    margin = np.full(len(x), t.first)

    def best(on: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> tuple:
        found = (-np.inf, 0, int(x[:, 0].max()))
        for f in range(x.shape[1]):
            for cut in np.unique(x[on, f])[:-1].tolist():
                low = on & (x[:, f] <= cut)
                high = on & ~low
                gain = sum(grad[s].sum() ** 2 / (hess[s].sum() + LEAVES_LEAST) for s in (low, high))
                if gain > found[0] + 1e-12:
                    found = (gain, f, cut)
        return found[1], found[2]

    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = ones - total * p, total * p * (1 - p)
        every = np.ones(len(x), bool)
        f, cut = best(every, grad, hess)
        sides = []
        for on in (x[:, f] <= cut, x[:, f] > cut):
            g, c = best(on, grad, hess) if on.any() else (0, 0)
            leaf = [float(RATE * grad[s].sum() / (hess[s].sum() + LEAVES_LEAST)) for s in (on & (x[:, g] <= c), on & (x[:, g] > c))]
            sides.append((g, c, *leaf))
        t.trees.append((f, cut, *sides))
        margin = t.margin(x)
    return t


def calibrate(t: Trees, x: np.ndarray, ones: np.ndarray, total: np.ndarray) -> None:
    """For each kind the lowest margin, but not below even odds, above which ``PRECISION`` holds."""
    m = t.margin(x)
    for k in range(len(KINDS)):
        t.thresholds[k], bad = np.inf, np.inf
        for cut in sorted(set(m[x[:, 0] == k].tolist())):
            on = (x[:, 0] == k) & (m >= cut)
            if ones[on].sum() / (total[on].sum() + 1) >= PRECISION:
                t.thresholds[k] = 0.0 if bad == np.inf else max(0.0, (bad + cut) / 2)
                break
            bad = cut


def fit(candidates: DataFrame) -> Trees:
    """Trees from one fold of ``candidates`` with ``label`` (null: undecided), thresholds from the other."""
    fold = (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2).alias("fold")
    cells = candidates.where("label IS NOT NULL").groupBy(fold, *FEATURES).agg(F.count("*").alias("n"), F.sum("label").alias("ones")).collect()
    cells.sort(key=lambda r: tuple(r))
    x = np.array([[r[f] for f in FEATURES] for r in cells], int).reshape(len(cells), len(FEATURES))
    n, ones, part = (np.array([r[c] for r in cells], float) for c in ("n", "ones", "fold"))
    t = boost(x[part == 0], ones[part == 0], n[part == 0])
    calibrate(t, x[part == 1], ones[part == 1], n[part == 1])
    return t


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added``.

    The counts and the digest are of base spans, ``spans`` holds the added ones too. Null
    and empty texts have no spans. Repeated rows and null ids are kept, each with its own
    result. Texts may be of any length. An empty table gives an empty table; other columns
    are not read.
    """
    text = df.select(F.monotonically_increasing_id().alias("rid"), df[id_col].alias("doc_id"), text_of(df, text_col).alias("t"))
    t = F.col("t")
    found = materialize(text.select("rid", "doc_id", *(_found(t, side[k], needs[k]).alias(f"{s}_{k}") for s, side, needs in (("b", BASE, BASE_NEEDS), ("g", GENERATORS, NEEDS)) for k in KINDS)))
    rows = materialize(spans(found).withColumn("valid", F.when(F.col("base"), _valid(F.col("kind"), F.col("m"))).otherwise(False)))
    rows = rows.where("valid OR NOT base")
    # Base spans of a kind don't overlap each other, so the last one that begins before a candidate and the first one after are all that can touch it.
    place = Window.partitionBy("rid", "kind").orderBy("start", "base", "end")
    before = F.max(F.when(F.col("base"), F.col("end"))).over(place.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(place.rowsBetween(1, Window.unboundedFollowing))
    same = F.max(F.col("base")).over(Window.partitionBy("rid", "kind", "start", "end"))
    marked = rows.withColumn("touch", (F.coalesce(before, F.lit(-1)) > F.col("start")) | (F.coalesce(after, F.lit(1 << 60)) < F.col("end"))).withColumn("same", same)
    c = features(marked.where("NOT base"))
    wrong = ~F.col("touch") & ((F.col("kind").isin(1, 2) & (F.col("f_check") == 0)) | (F.col("f_cue") == 0))
    c = c.withColumn("label", F.when(F.col("same"), 1).when(wrong, 0))
    c = materialize(c.select("rid", "doc_id", "start", "end", "label", "touch", "same", *FEATURES))
    examples = features(planted(rows.where("base"))).select("doc_id", "label", *FEATURES)
    trees = fit(c.select("doc_id", "label", *FEATURES).unionByName(examples))
    limit = F.lit(float("inf"))
    for k, cut in enumerate(trees.thresholds):
        limit = F.when(F.col("kind") == k, F.lit(float(cut))).otherwise(limit)
    # A number that fails its kind's check is evidence for training, but never personal data.
    sound = ~F.col("kind").isin(1, 2) | (F.col("f_check") == 1)
    added = c.where(~F.col("touch") & ~F.col("same") & sound).where(trees.column() >= limit).select("rid", "kind", F.lit(False).alias("base"), "start", "end")
    every = rows.where("base").select("rid", "kind", "base", "start", "end").unionByName(added)
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    span = F.struct("start", "kind", "end", F.concat_ws(":", name, F.col("start").cast("string"), F.col("end").cast("string")).alias("s"))
    written = lambda x: F.concat_ws(",", F.transform(F.array_sort(x), lambda y: y["s"]))
    by_doc = every.groupBy("rid").agg(
        *(F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{n}") for k, n in enumerate(KINDS)),
        F.sha2(written(F.collect_list(F.when(F.col("base"), span))).cast("binary"), 256).alias("base_sha256"),
        written(F.collect_list(span)).alias("spans"),
        F.count_if(~F.col("base")).alias("n_added"),
    )
    out = found.select("rid", "doc_id").join(by_doc, "rid", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    none = F.sha2(F.lit("").cast("binary"), 256)
    return out.select("doc_id", *(zero(f"n_{k}") for k in KINDS), F.coalesce("base_sha256", none).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), zero("n_added"))


def op5_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document of the whole table."""
    return find(documents(spark, sf_dir))
