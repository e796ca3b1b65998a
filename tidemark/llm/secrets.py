"""Secret scan: three base patterns plus a randomness test battery, as column expressions only.

Base kinds (leftmost, non-overlapping per kind; failing matches are dropped after matching):
``assign`` (keyword, sign, value of 6+), ``access`` (20+), ``hex`` (24+). The battery looks at
runs of 20+ characters of the usual encodings, infers the encoding of each, and asks three
tests whether its symbols look uniformly random:

* chi-squared over eight equal classes of the inferred alphabet,
* Wald-Wolfowitz runs above and below the middle of the alphabet,
* lag-1 serial correlation of symbol indices.

Their p-values are combined by Fisher's rule. Within each stratum (encoding, length band) the
Benjamini-Hochberg step-up at level ``fdr`` declares tokens *structured*; short tokens are thus
only compared with short ones, whose tests have the same power. What is not declared
structured is reported as kind ``random`` unless a base span covers part of it.

The step-up needs only counts of tokens per stratum and p-value bin (``P_BINS`` per unit of
-log10 p up to ``P_MAX``): at most len(ENCODINGS) * BANDS * P_BINS * P_MAX counts, whatever the
input. Its thresholds, one per stratum, reach the driver and return as literals.

Nulls and empty texts give no spans (digest of the empty string); repeated rows give equal
results; other columns of the input are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The kinds in the order of their listing, with pattern, group and least length.
ASSIGN = (r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])"
          r"|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"
          r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the runs of 20+ are those of AKIA[A-Z0-9]+ that are long enough
HEX = r"[0-9a-f]{24,}"  # likewise of [0-9a-f]+
KINDS = ("assign", "access", "hex", "random")

TOKEN = r"[A-Za-z0-9+/_-]{20,}"
MIN_TOKEN = 20
CLASSES = 8
ENCODINGS = {  # inferred in this order
    "hex": ("^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    "base32": ("^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "base64": ("^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    "base64url": ("^[A-Za-z0-9_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
}
BANDS = 12  # by powers of the square root of two from MIN_TOKEN
P_BINS, P_MAX = 20, 30
FDR = 0.05
MASK = "[SECRET]"


def _located(text: Column, pattern: str, keep=None) -> Column:
    """array<struct<start, end, tok>> of the matches of ``pattern`` (code points, end exclusive).

    Spark's functions give matches without places, so places are summed from the pieces
    between matches and the matches themselves. ``keep`` filters after matching.
    """
    pat = F.lit(pattern)
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                         F.regexp_extract_all(text, pat, 0).alias("tok"))
    none = F.expr("cast(array() as array<struct<start:int,end:int,tok:string>>)")
    zero = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["tok"])
        one = F.struct(start.alias("start"), end.alias("end"), x["tok"].alias("tok"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    found = F.aggregate(F.filter(parts, lambda x: x["tok"].isNotNull()), zero, step, lambda a: a["out"])
    found = F.when(text.rlike(pattern), found).otherwise(none)
    return F.filter(found, keep) if keep else found


def _tails(zs: Column) -> Column:
    """P(|Z| > |z|) for each, Abramowitz and Stegun 26.2.17 (error under 1e-7), floored for logarithms."""
    at = F.transform(zs, lambda z: F.struct(F.abs(z).alias("x"), (1 / (1 + 0.2316419 * F.abs(z))).alias("t")))

    def tail(a):
        x, t = a["x"], a["t"]
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return F.greatest(2 * 0.3989422804014327 * F.exp(-x * x / 2) * poly, F.lit(1e-30))

    return F.transform(at, tail)


def _sum(xs: Column, f) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + f(x))


def _tested(found: Column) -> Column:
    """Tokens with an inferred encoding: struct(start, end, enc, band, p)."""
    def infer(t):
        tok = t["tok"]
        mixed = tok.rlike("[0-9]") & tok.rlike("[A-Z]") & tok.rlike("[a-z]")
        enc = F.when(tok.rlike(ENCODINGS["hex"][0]) & tok.rlike("[0-9]"), "hex")
        enc = enc.when(tok.rlike(ENCODINGS["base32"][0]) & tok.rlike("[2-7]") & tok.rlike("[A-Z]"), "base32")
        for name in ("base64", "base64url"):
            enc = enc.when(tok.rlike(ENCODINGS[name][0]) & mixed, name)
        return F.struct(t["start"].alias("start"), t["end"].alias("end"), tok.alias("tok"), enc.alias("enc"))

    def index(t):
        letters = F.when(t["enc"] == "hex", F.lit(ENCODINGS["hex"][1]))
        for name in ("base32", "base64"):
            letters = letters.when(t["enc"] == name, F.lit(ENCODINGS[name][1]))
        letters = letters.otherwise(F.lit(ENCODINGS["base64url"][1]))
        tok = F.when(t["enc"] == "hex", F.lower(t["tok"])).otherwise(t["tok"])
        ix = F.transform(F.split(tok, ""), lambda c: (F.instr(letters, c) - 1).cast("double"))
        return F.struct(t["start"].alias("start"), t["end"].alias("end"), t["enc"].alias("enc"),
                        F.length(letters).cast("double").alias("k"), ix.alias("ix"))

    def stats(t):
        ix, k = t["ix"], t["k"]
        n = F.size(ix).cast("double")
        counts = F.transform(F.sequence(F.lit(0), F.lit(CLASSES - 1)), lambda c: _sum(
            ix, lambda x: F.when(F.floor(x * CLASSES / k) == c, 1.0).otherwise(0.0)))
        chi = _sum(counts, lambda c: c * c) * CLASSES / n - n
        high = F.transform(ix, lambda x: F.when(x >= k / 2, 1.0).otherwise(0.0))
        pairs = F.arrays_zip(F.slice(ix, F.lit(1), F.size(ix) - 1).alias("a"),
                             F.slice(ix, F.lit(2), F.size(ix) - 1).alias("b"))
        up = _sum(high, lambda x: x)
        runs = 1 + _sum(pairs, lambda p: F.when((p["a"] >= k / 2) != (p["b"] >= k / 2), 1.0).otherwise(0.0))
        mean = _sum(ix, lambda x: x) / n
        return F.struct(t["start"].alias("start"), t["end"].alias("end"), t["enc"].alias("enc"), n.alias("n"),
                        chi.alias("chi"), up.alias("up"), runs.alias("runs"), mean.alias("mean"),
                        ix.alias("ix"), pairs.alias("pairs"))

    def moments(t):
        n, up, m = t["n"], t["up"], t["mean"]
        keep = [t[x].alias(x) for x in ("start", "end", "enc", "n", "chi", "runs")]
        return F.struct(*keep, (2 * up * (n - up) / n).alias("mu"),
                        _sum(t["ix"], lambda x: (x - m) * (x - m)).alias("ss"),
                        _sum(t["pairs"], lambda p: (p["a"] - m) * (p["b"] - m)).alias("cov"))

    def scores(t):
        n, mu, c = t["n"], t["mu"], 2.0 / (9 * (CLASSES - 1))
        z_chi = (F.pow(F.greatest(t["chi"], F.lit(0.0)) / (CLASSES - 1), F.lit(1 / 3)) - (1 - c)) / c ** 0.5
        var = mu * (mu - 1) / (n - 1)
        z_runs = F.when(var > 0, (t["runs"] - mu - 1) / F.sqrt(var)).otherwise(F.lit(6.0))  # all on one side
        z_corr = F.when(t["ss"] > 0, (t["cov"] / t["ss"] + 1 / n) * F.sqrt(n)).otherwise(F.lit(6.0))
        return F.struct(t["start"].alias("start"), t["end"].alias("end"), t["enc"].alias("enc"), n.alias("n"),
                        (z_chi > 0).alias("above"), _tails(F.array(z_chi, z_runs, z_corr)).alias("ps"))

    def fisher(t):  # half of Fisher's statistic, which has 6 degrees of freedom
        chi = F.when(t["above"], t["ps"][0] / 2).otherwise(1 - t["ps"][0] / 2)
        h = -(F.log(chi) + F.log(t["ps"][1]) + F.log(t["ps"][2]))
        return F.struct(t["start"].alias("start"), t["end"].alias("end"), t["enc"].alias("enc"), t["n"].alias("n"), h.alias("h"))

    def binned(t):
        h = t["h"]
        p = F.greatest(F.exp(-h) * (1 + h + h * h / 2), F.lit(1e-300))
        band = F.least(F.floor(2 * F.log2(t["n"] / MIN_TOKEN)), F.lit(BANDS - 1)).cast("int")
        at = F.greatest(F.floor(F.least(-F.log10(p) * P_BINS, F.lit(P_BINS * P_MAX))), F.lit(0)).cast("int")
        return F.struct(t["start"].alias("start"), t["end"].alias("end"), t["enc"].alias("enc"), band.alias("band"), at.alias("bin"))

    known = F.filter(F.transform(found, infer), lambda t: t["enc"].isNotNull())
    for stage in (index, stats, moments, scores, fisher, binned):
        known = F.transform(known, stage)
    return known


def thresholds(tokens: DataFrame, fdr: float = FDR) -> dict[tuple[str, int], int]:
    """Least bin of -log10 p that is declared structured, per stratum, by the step-up rule.

    tokens: one row per token with enc, band and bin. A bin counts with its largest p-value, so
    the rule errs to the side of keeping a token. Strata without a discovery are absent.
    """
    per = tokens.groupBy("enc", "band", "bin").agg(F.count("*").alias("n"))
    w = Window.partitionBy("enc", "band")
    got = (per.withColumn("rank", F.sum("n").over(w.orderBy(F.desc("bin"))))
           .withColumn("all", F.sum("n").over(w))
           .filter(F.pow(F.lit(10.0), -F.col("bin") / P_BINS) <= F.lit(fdr) * F.col("rank") / F.col("all"))
           .groupBy("enc", "band").agg(F.min("bin").alias("least")))
    return {(r["enc"], r["band"]): r["least"] for r in got.collect()}


def _with_tests(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_text", F.coalesce(F.col("text"), F.lit(""))).withColumn(
        "_tested", _tested(_located(F.col("_text"), TOKEN)))


def _spans(docs: DataFrame, fdr: float) -> DataFrame:
    """docs with ``_base`` and ``_all``: sorted arrays of struct(start, kind no., end)."""
    tested = _with_tests(docs)
    limits = thresholds(tested.select(F.explode("_tested").alias("t")).select("t.*"), fdr)
    text = F.col("_text")

    def tagged(found, k):
        return F.transform(found, lambda t: F.struct(t["start"].alias("start"), F.lit(k).alias("kind"),
                                                     t["end"].alias("end")))

    value = F.regexp_extract_all(text, F.lit(ASSIGN), 2)
    assign = F.transform(
        F.filter(F.arrays_zip(_located(text, ASSIGN).alias("m"), value.alias("v")),
                 lambda x: F.length(x["v"]) >= 6), lambda x: x["m"])
    assign = F.when(text.rlike(ASSIGN), assign).otherwise(_located(F.lit(""), ASSIGN))
    least = F.create_map(*[F.lit(x) for (e, b), n in sorted(limits.items()) for x in (f"{e}:{b}", n)]) if limits else None

    def random(t):
        if least is None:
            return F.lit(True)
        cut = F.element_at(least, F.concat_ws(":", t["enc"], t["band"].cast("string")))
        return cut.isNull() | (t["bin"] < cut)

    base = F.array_sort(F.concat(tagged(assign, 0), tagged(_located(text, ACCESS), 1), tagged(_located(text, HEX), 2)))
    out = tested.withColumn("_base", base)
    more = F.filter(F.col("_tested"), lambda t: random(t) & ~F.exists(
        F.col("_base"), lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return out.withColumn("_all", F.array_sort(F.concat(F.col("_base"), tagged(more, 3))))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans) for each row of docs(doc_id, text)."""
    s = _spans(docs.select("doc_id", "text"), fdr)

    def count(k):
        return F.size(F.filter("_all", lambda x: x["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    n = [count(k) for k in range(len(KINDS))]
    return s.select("doc_id", *n, F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"),
                    _joined(F.col("_all")).alias("spans"))


def redact(docs: DataFrame, fdr: float = FDR, mask: str = MASK) -> DataFrame:
    """docs with every span of ``text`` replaced by ``mask`` (touching or overlapping ones by
    one mask) and ``n_chars`` brought up to date; all other columns and texts unchanged."""
    kept = docs.columns
    s = _spans(docs, fdr)
    text = F.col("_text")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a, x):
        fresh = F.concat(a["out"], F.substring(text, a["at"] + 1, x["start"] - a["at"]), F.lit(mask))
        again = (x["start"] < a["at"]) | ((x["start"] == a["at"]) & (a["at"] > 0))
        return F.struct(F.greatest(a["at"], x["end"]).alias("at"), F.when(again, a["out"]).otherwise(fresh).alias("out"))

    made = F.aggregate("_all", zero, step,
                       lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    hit = F.size("_all") > 0
    out = s.withColumn("text", F.when(hit, made).otherwise(F.col("text")))
    if "n_chars" in kept:
        out = out.withColumn("n_chars", F.when(hit & F.col("n_chars").isNotNull(),
                                               F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*kept)
