"""N-gram Jaccard join: PartEnum signatures over five-word shingle sets (Arasu, Ganti, Kaushik,
"Efficient exact set-similarity joins", 2006).

1. Shingles to shared shingles. A document can only have a partner if at least ``threshold`` of
   its shingles occur in some other document. Shingle hashes (48 bits) travel in packed blocks,
   one per chunk of documents and hash range; each range keeps those seen in two documents and
   sends them back. Intersections are made of shared shingles alone, so nothing else is needed
   from here on. Exact copies inside a chunk are one entry; equal sets become one class later.
2. PartEnum over the shared sets (removing unshared shingles cannot lower a similarity). Sets
   fall into bands of sizes with ratio 1 : 1/threshold; a set has signatures in its own band
   and the one below, so any two similar sets share a band. The hash range is cut into ordered
   partitions, each into thirds, and signatures are the two-thirds unions. A set A that may
   differ from a partner in k shingles (from its own sizes) has at most k/2 partitions with two
   differences or more; in any other partition two of three thirds are equal. So one of the
   first k/2 + 1 partitions of A whose unions are all non-empty gives a common signature, and
   A emits the non-empty unions up to the last of these. A set with too few such partitions
   emits all unions and each shingle, so two of them meet as well.
3. Links between signature groups, never all pairs of a group: rounds in which each group
   checks its members against two pivots merge copies into components, until the pairs of
   different components in common groups are no more than the signatures were at first (or a
   round no longer lowers them by a fifth); then those pairs are checked exactly on the sets,
   in tiles inside a task where a component or a group is large (``_remaining``).

Documents without words have an empty set and no links. Null texts count as empty; repeated
rows and equal sets are linked (also when the id is repeated); null ids keep component null.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import pack, unpack
from tidemark.llm.graph import components
from tidemark.llm.rows import give_back, id_text, ids_of, small_batches
from tidemark.llm.scratch import stored
from tidemark.llm.words import mix, shingle_set
from tidemark.session import cut_lineage

THRESHOLD = (75, 100)  # as a fraction, so that all bounds are exact
CHUNK = 1 << 20  # shingles a chunk
RANGE_CHARS = 1 << 23  # of text for each range of hashes: what a range holds is bounded, whatever the input
MAX_PIVOT_ROUNDS = 12
BIG = 64  # a component of so many sets is checked as a whole, not through its signatures
SALTS = 64
CROWD = 32  # components that share a signature and are checked in tiles, not as listed pairs
TILE = 1024  # sets, and
TILE_BYTES = 1 << 23  # bytes of sets, on each side of a tile
PAIRS = 1 << 20
DENSE = 1 << 14  # a shingle with so many pairs of owners in a tile is counted by a matrix product
_U = np.uint64
_LOW = _U(16)  # bits of a hash that are dropped: two sets of n shingles differ by chance in n * n / 2**48


# ---- 1: shared shingles ------------------------------------------------------------------

def _packed(hashes: np.ndarray) -> bytes:
    """Ascending 48-bit hashes (left-aligned in 64 bits) as their differences."""
    h = (hashes >> _LOW).astype(np.int64)
    return pack(np.diff(h, prepend=0))


def _hashes(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob)).astype(_U) << _LOW


def _flat(hashes: np.ndarray) -> bytes:
    """Six bytes a hash: the bits that count, ascending."""
    return np.ascontiguousarray((hashes >> _LOW).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _set(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(_U) << _LOW


def _blocks(ranges: int):
    """Documents -> per chunk: one row of documents and one block of hashes per range."""
    def flush(rows, sets):
        marks = [xxhash.xxh3_128(s.tobytes()).digest() for s in sets]
        first: dict[bytes, int] = {}
        entry = np.array([first.setdefault(m, i) for i, m in enumerate(marks)], "<u4")
        own = np.array(sorted(first.values()), np.int64)
        h = np.concatenate([sets[i] for i in own]) >> _LOW << _LOW
        e = np.repeat(own, [len(sets[i]) for i in own])
        by = np.argsort(h, kind="stable")
        h, e = h[by], e[by]
        name = xxhash.xxh3_64(b"".join(marks) + repr(rows).encode()).intdigest()
        chunk = int(_U(name).astype(np.int64))
        ids = ids_of(rows)
        out = [{"chunk": chunk, "part": ranges + chunk % ranges, "hashes": b"".join(marks), "entries": entry.tobytes(),
                "ids": ids.to_numpy("<i8", na_value=0).tobytes(), "null": ids.isna().astype(np.uint8).tobytes(),
                "sizes": np.array([len(s) for s in sets], "<i8").tobytes()}]
        cut = np.searchsorted(h, [_U((p << 64) // ranges) for p in range(1, ranges)])
        for p, (hs, es) in enumerate(zip(np.split(h, cut), np.split(e, cut))):
            if len(hs):
                out.append({"chunk": chunk, "part": p, "hashes": _packed(hs), "entries": pack(es),
                            "ids": None, "null": None, "sizes": None})
        return pd.DataFrame(out)

    def run(batches):
        rows, sets, held = [], [], 0
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                rows.append(doc_id)
                sets.append(shingle_set(text))
                held += len(sets[-1]) + 8
                if held >= CHUNK:
                    yield flush(rows, sets)
                    rows, sets, held = [], [], 0
                    give_back()
        if rows:
            yield flush(rows, sets)
    return run


_BLOCK = "chunk long, part int, hashes binary, entries binary, ids binary, null binary, sizes binary"


def _seen_twice(pdf: pd.DataFrame) -> pd.DataFrame:
    """One hash range: keeps, of each chunk's block, the hashes that two entries have."""
    if pdf["ids"].iloc[0] is not None:
        return pdf  # the documents' rows pass
    blocks = [_hashes(b) for b in pdf["hashes"]]
    h = np.sort(np.concatenate(blocks))
    again = h[1:][h[1:] == h[:-1]]
    again = again[np.r_[True, again[1:] != again[:-1]]] if len(again) else again
    out = []
    for row, own in zip(pdf.itertuples(index=False), blocks):
        at = np.searchsorted(again, own)
        hit = (again[np.minimum(at, len(again) - 1)] == own) if len(again) else np.zeros(len(own), bool)
        if hit.any():
            out.append((row.chunk, row.part, _packed(own[hit]), pack(unpack(row.entries)[hit]), None, None, None))
    del blocks, h, again
    give_back()
    return pd.DataFrame(out, columns=list(pdf.columns))


def _sets(num: int, den: int):
    """One chunk: each document's id, set size, set digest and, for the first with an id of equal
    ones that can have a partner, its shared shingles."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        parts = pdf[pdf["ids"].isna()]
        h = np.concatenate([np.empty(0, _U), *map(_hashes, parts["hashes"])])
        e = np.concatenate([np.empty(0, np.int64), *map(unpack, parts["entries"])])
        by = np.lexsort((h, e))
        h, e = h[by], e[by]
        h, e = (x[np.r_[True, (h[1:] != h[:-1]) | (e[1:] != e[:-1])]] for x in (h, e)) if len(h) else (h, e)
        for row in pdf[pdf["ids"].notna()].itertuples(index=False):
            ids, null = np.frombuffer(row.ids, "<i8"), np.frombuffer(row.null, np.uint8)
            sizes, entry = np.frombuffer(row.sizes, "<i8"), np.frombuffer(row.entries, "<u4")
            bearer = np.full(len(ids), -1)  # of equal texts the first with an id: rows without one are in no link
            named = np.flatnonzero(null == 0)[::-1]
            bearer[entry[named]] = named
            for i in range(len(ids)):
                shared = None
                if bearer[entry[i]] == i and sizes[i]:
                    a, b = np.searchsorted(e, [entry[i], entry[i] + 1])
                    if den * (b - a) >= num * sizes[i]:
                        shared = _flat(h[a:b])
                out.append((None if null[i] else str(ids[i]), sizes[i], row.hashes[16 * i: 16 * i + 16], shared))
        got = pd.DataFrame(out, columns=["doc_id", "n", "mark", "shared"])
        return got.assign(doc_id=ids_of(got["doc_id"]))
    return run


def shared_sets(docs: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """(doc_id, n, mark, shared) per document: set size, digest of the set, packed shared shingles."""
    small_batches(docs.sparkSession)
    ranges = max(64, int(docs.agg(F.sum(F.length("text"))).first()[0] or 0) // RANGE_CHARS)
    rows = docs.select(id_text("doc_id").alias("doc_id"), "text").mapInPandas(_blocks(ranges), _BLOCK)
    kept = rows.groupBy("part").applyInPandas(_seen_twice, _BLOCK)
    return kept.groupBy("chunk").applyInPandas(_sets(*threshold), "doc_id long, n long, mark binary, shared binary")


# ---- 2: signatures -----------------------------------------------------------------------

def _bands(num: int, den: int, top: int) -> list[tuple[int, int]]:
    """Size bands [l, r] with r = floor(l * den / num), from 1."""
    out, l = [], 1
    while l <= top:
        r = l * den // num
        out.append((l, r))
        l = r + 1
    return out


def most_differences(a: int, n: int, b: int, num: int, den: int) -> int:
    """The most shared shingles by which a set (a shared ones, n in all) and a partner with up to
    b shared ones can differ: a + b - 2 |A and B|, where |A and B| >= num/(num+den) (n + size of B)."""
    return ((a + b) * (num + den) - 2 * num * (n + b)) // (num + den)


def signatures_of(h: np.ndarray, n: int, bands: list[tuple[int, int]], num: int, den: int) -> np.ndarray:
    """Signatures of one sorted set of shared hashes (n shingles in all) in its band and the one below."""
    a, out = len(h), []
    own = next(i for i, (l, r) in enumerate(bands) if l <= a <= r)
    for band in (own - 1, own):
        if band < 0:
            continue
        low, high = bands[band]
        k = most_differences(a, n, a * den // num if band == own else high, num, den)
        if k < 0:
            continue
        need = k // 2 + 1
        # the partitions are the band's: enough for its largest possible k
        parts = -(-27 * ((den - num) * high // num // 2 + 1) // 20)
        cell = ((h >> _U(32)) * _U(3 * parts)) >> _U(32)  # ascending, as h is
        start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        cells = np.zeros(3 * parts, _U)
        cells[cell[start]] = np.add.reduceat(mix(h ^ _U(0xA5A5A5A5A5A5A5A5)), start)
        full = np.zeros(3 * parts, bool)
        full[cell[start]] = True
        thirds, full = cells.reshape(-1, 3), full.reshape(-1, 3)
        unions = np.stack([full[:, x] | full[:, y] for x, y in ((0, 1), (0, 2), (1, 2))], 1)
        good = np.flatnonzero(unions.all(1))
        last = int(good[need - 1]) + 1 if len(good) >= need else parts
        salt = mix(_U(band * 1_000_003 + 17) + np.arange(3 * parts, dtype=_U) * _U(0x9E3779B97F4A7C15)).reshape(-1, 3)
        for at, (x, y) in enumerate(((0, 1), (0, 2), (1, 2))):
            sig = mix(mix(thirds[:last, x] + salt[:last, at]) + thirds[:last, y] * _U(3))
            out.append(sig[unions[:last, at]])
        if len(good) < need:
            out.append(mix(h ^ mix(np.array([band + 7_777_777], _U))))
    return np.unique(np.concatenate(out)) if out else np.empty(0, _U)


def _signatures(num: int, den: int):
    def run(batches):
        bands: list[tuple[int, int]] = []
        for pdf in batches:
            sigs, ids, ns = [], [], []
            for doc, n, shared in zip(pdf["id"], pdf["n"], pdf["shared"]):
                h = _set(shared)
                if not bands or bands[-1][1] < len(h):
                    bands = _bands(num, den, 2 * len(h))
                s = signatures_of(h, n, bands, num, den)
                sigs.append(s.astype(np.int64))
                ids.append(np.full(len(s), doc))
                ns.append(np.full(len(s), n))
                if sum(map(len, sigs)) > 1 << 18:
                    yield pd.DataFrame({"sig": np.concatenate(sigs), "id": np.concatenate(ids), "n": np.concatenate(ns)})
                    sigs, ids, ns = [], [], []
            if sigs:
                yield pd.DataFrame({"sig": np.concatenate(sigs), "id": np.concatenate(ids), "n": np.concatenate(ns)})
    return run


# ---- 3: links ----------------------------------------------------------------------------

def _common(batches):
    for pdf in batches:
        got = [len(np.intersect1d(_set(a), _set(b), assume_unique=True))
               for a, b in zip(pdf["sa"], pdf["sb"])]
        yield pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "na": pdf["na"], "nb": pdf["nb"], "both": np.array(got, np.int64)})


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """pairs (a, b) -> those whose sets reach the threshold, exactly."""
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("sb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "sa", "sb")
    checked = both.mapInPandas(_common, "a long, b long, na long, nb long, both long")
    return checked.filter(f"{den} * both >= {num} * (na + nb - both)").select("a", "b")


def _in_size(pairs: DataFrame, num: int, den: int) -> DataFrame:
    return pairs.filter(f"{den} * least(na, nb) >= {num} * greatest(na, nb)").select("a", "b").distinct()


def _labels(ids: DataFrame, links: DataFrame) -> DataFrame:
    return ids.join(components(links, "a", "b"), "id", "left").select(
        "id", F.coalesce("component", "id").alias("comp"))


def link_classes(sets: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """sets (id, n, shared): links (a, b) that connect exactly the sets connected by similarity."""
    num, den = threshold
    rows = sets.select("id", "n", "shared").mapInPandas(_signatures(num, den), "sig long, id long, n long")
    met = rows.groupBy("sig").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo != hi").select("sig")
    rows = stored(rows.join(met, "sig").withColumn("comp", F.col("id")))
    links = cut_lineage(sets.sparkSession.createDataFrame([], "a long, b long"))
    budget, before = rows.count(), None
    for turn in range(MAX_PIVOT_ROUNDS):
        total = _open_pairs(rows)
        if total <= budget or (before is not None and total > 0.8 * before):
            break
        before = total
        order = F.xxhash64("id", F.lit(turn))
        one = F.struct(order.alias("o"), "id", "n", "comp")
        pivots = rows.groupBy("sig").agg(F.min(one).alias("p"), F.max(one).alias("q"))
        # at most two rows for each signature row: linear in the input, whatever the groups
        pairs = (rows.join(pivots, "sig").withColumn("p", F.explode(F.array("p", "q"))).filter("comp != p.comp").select(
            F.least("id", "p.id").alias("a"), F.greatest("id", "p.id").alias("b"), F.col("n").alias("na"), F.col("p.n").alias("nb")))
        links = cut_lineage(links.unionByName(_verified(_in_size(pairs, num, den), sets, num, den)))
        rows = _relabelled(rows, links)
    return links.unionByName(_remaining(rows, sets, num, den))


def _open_pairs(rows: DataFrame) -> int:
    """Pairs of different components in common groups, counted without listing them."""
    per = rows.select("sig", "comp").distinct().groupBy("sig").agg(F.count("*").alias("d"))
    return int(per.agg(F.sum(F.col("d") * (F.col("d") - 1) / 2)).first()[0] or 0)


def _relabelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Signature rows with their ids' components, of groups that still span several."""
    old, label = rows, _labels(rows.select("id").distinct(), links)
    rows = rows.drop("comp").join(label, "id")
    open_ = rows.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi").select("sig")
    return stored(rows.join(open_, "sig"), instead_of=old)


def _common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many hashes each left set shares with each right one. Hashes with many owners on both
    sides go through matrix products, the others through their lists of owners."""
    both = np.zeros((len(left), len(right)), np.int32)
    flat = np.concatenate([np.empty(0, _U), *left, *right])
    owner = np.concatenate([np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right)])
    mine = np.arange(len(flat)) < sum(map(len, left))
    names, code = np.unique(flat, return_inverse=True)
    code = code.ravel()
    n_left = np.bincount(code[mine], minlength=len(names))
    n_right = np.bincount(code[~mine], minlength=len(names))
    work = n_left * n_right
    wide = np.flatnonzero(work >= DENSE)
    column = np.full(len(names), -1)
    column[wide] = np.arange(len(wide))
    for at in range(0, len(wide), 1024):
        x, y = (np.zeros((len(side), 1024), np.float32) for side in (left, right))
        own = column[code]
        hit = (own >= at) & (own < at + 1024)
        x[owner[hit & mine], own[hit & mine] - at] = 1
        y[owner[hit & ~mine], own[hit & ~mine] - at] = 1
        both += (x @ y.T).astype(np.int32)
    rare = (work > 0) & (work < DENSE)
    keep = rare[code]
    a, b = keep & mine, keep & ~mine
    oa, ca = owner[a], code[a]
    by = np.argsort(code[b], kind="stable")
    ob, cb = owner[b][by], code[b][by]
    start, n = np.searchsorted(cb, ca), n_right[ca]
    ends = np.cumsum(n)
    lo = 0
    while lo < len(ca):  # pairs of owners, about PAIRS at a time
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - n[lo] + PAIRS, side="right")))
        m = n[lo:hi]
        place = np.repeat(start[lo:hi] - (ends[lo:hi] - m - (ends[lo] - n[lo])), m) + np.arange(int(m.sum()))
        pair = np.repeat(oa[lo:hi], m) * len(right) + ob[place]
        both += np.bincount(pair, minlength=both.size).reshape(both.shape).astype(np.int32)
        lo = hi
    return both


def _matching(left: pd.DataFrame, right: pd.DataFrame, num: int, den: int) -> pd.DataFrame:
    """A spanning forest of the links between different components in two tables of sets (id, n, comp, shared)."""
    both = _common_counts([_set(x) for x in left["shared"]], [_set(x) for x in right["shared"]])
    na, nb = left["n"].to_numpy()[:, None], right["n"].to_numpy()[None, :]
    ca, cb = left["comp"].to_numpy(), right["comp"].to_numpy()
    i, j = np.nonzero((den * both >= num * (na + nb - both)) & (ca[:, None] != cb[None, :]))
    _, first = np.unique(np.stack([np.minimum(ca[i], cb[j]), np.maximum(ca[i], cb[j])]), axis=1, return_index=True)
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    ia, ib, out = left["id"].to_numpy(), right["id"].to_numpy(), []
    for k in first:
        x, y = find(ca[i[k]]), find(cb[j[k]])
        if x != y:
            parent[x] = y
            out.append((min(ia[i[k]], ib[j[k]]), max(ia[i[k]], ib[j[k]])))
    del both, i, j
    give_back()
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _stripes(df: DataFrame, sets: DataFrame, *by: str) -> DataFrame:
    """Stripes that the sets of ``df`` (<by>, id) are dealt into for a tile to be of bounded size."""
    sized = df.join(sets.select("id", F.octet_length("shared").alias("_bytes")), "id")
    return sized.groupBy(*by).agg(F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum("_bytes") / TILE_BYTES)).cast("int").alias("stripes"))


def _remaining(rows: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links among the pairs of different components that still share a signature.

    Against a big component every set that shares a signature with it is checked with all its
    members, once; crowds of other components under one signature are checked inside the
    group; both in tiles of about TILE sets a side, whose links between components leave as a
    spanning forest, so pairs are never rows. The rest,
    fewer than CROWD components a signature, is listed as pairs.
    """
    # a component may hold most sets: its size reaches them through SALTS keys
    ids = rows.select("id", "comp").distinct().withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    big = (ids.groupBy("comp").agg(F.count("*").alias("size")).filter(F.col("size") >= BIG)
           .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))))
    sized = ids.join(big, ["comp", "salt"], "left").select("id", F.coalesce("size", F.lit(1)).alias("size"))
    rows = stored(rows.join(sized, "id"), instead_of=rows)
    return (_against_big(rows, sets, num, den).unionByName(_in_crowds(rows, sets, num, den))
            .unionByName(_verified(_listed(rows, num, den), sets, num, den)))


def _against_big(rows: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    big = rows.filter(F.col("size") >= BIG)
    under = big.select("sig", F.col("comp").alias("big")).distinct()
    probes = (rows.join(under, "sig").filter(f"comp != big and (size < {BIG} or comp < big)")
              .select("big", "id", "comp").distinct())
    members = big.select(F.col("comp").alias("big"), "id", "comp").distinct()

    def dealt(df, n, other):  # own stripe by id, and a copy for each stripe of the other side
        df = df.join(counts, "big").join(sets, "id")
        return (df.withColumn(n, F.pmod(F.xxhash64("id"), F.col(f"n_{n}")).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1)))
                .select("big", "x", "y", "id", "n", "comp", "shared"))

    counts = cut_lineage(_stripes(probes, sets, "big").withColumnRenamed("stripes", "n_x").join(
        _stripes(members, sets, "big").withColumnRenamed("stripes", "n_y"), "big"))
    left, right = dealt(probes, "x", "y"), dealt(members, "y", "x")
    right = right.select(*[F.col(c).alias(c if c not in ("big", "x", "y") else f"_{c}") for c in right.columns])

    def work(own: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        return _matching(own, other, num, den) if len(own) and len(other) else pd.DataFrame({"a": [], "b": []}, dtype="int64")

    return left.groupBy("big", "x", "y").cogroup(right.groupBy("_big", "_x", "_y")).applyInPandas(work, "a long, b long")


def _crowds(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of small components, with the number of components under their signature."""
    small = rows.filter(F.col("size") < BIG)
    d = small.select("sig", "comp").distinct().groupBy("sig").agg(F.count("*").alias("d")).filter("d > 1")
    return small, d


def _in_crowds(rows: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    small, d = _crowds(rows)
    own = small.join(d.filter(F.col("d") >= CROWD), "sig").select("sig", "id", "comp", "d").distinct()
    own = own.join(_stripes(own, sets, "sig"), "sig").withColumn("s", F.pmod(F.xxhash64("id"), F.col("stripes")).cast("int"))
    own = own.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("stripes") - 1)))
    own = own.join(sets, "id").select("sig", F.least("s", "o").alias("ti"), F.greatest("s", "o").alias("tj"), "s", "id", "n", "comp", "shared")

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = pdf["ti"].iloc[0], pdf["tj"].iloc[0]
        return _matching(pdf[pdf["s"] == i], pdf[pdf["s"] == j], num, den)

    return own.groupBy("sig", "ti", "tj").applyInPandas(work, "a long, b long")


def _listed(rows: DataFrame, num: int, den: int) -> DataFrame:
    small, d = _crowds(rows)
    few = small.join(d.filter(F.col("d") < CROWD), "sig").select("sig", "id", "n", "comp")
    one, two = (few.select("sig", *[F.col(c).alias(f"{c}{k}") for c in ("id", "n", "comp")]) for k in "ab")
    pairs = one.join(two, "sig").filter("compa < compb")
    return _in_size(pairs.select(F.col("ida").alias("a"), F.col("idb").alias("b"), "na", "nb"), num, den)


def join_documents(docs: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document."""
    every = stored(shared_sets(docs, threshold))
    filled = every.filter("n > 0 and doc_id is not null")
    # laid out by id once: every later join with the sets moves the other side alone
    sets = (filled.groupBy("mark").agg(F.min("doc_id").alias("id"), F.max("n").alias("n"), F.min("shared").alias("shared"))
            .filter("shared is not null").select("id", "n", "shared"))
    sets = cut_lineage(sets.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id"))
    every = stored(every.drop("shared"), instead_of=every)
    filled = every.filter("n > 0 and doc_id is not null")
    classes = filled.groupBy("mark").agg(F.min("doc_id").alias("id"))
    links = link_classes(sets, threshold)
    label = components(links, "a", "b")
    # a repeated id may stand in several classes: they are the same node of the graph
    twice = filled.join(classes, "mark").select("doc_id", "id")
    moved = twice.join(label, "id", "left").select("doc_id", F.coalesce("component", "id").alias("component"))
    moved = moved.groupBy("doc_id").agg(F.min("component").alias("component"))
    return every.join(moved, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """docs with one row of each group of rows that similarity links, the one with the smallest id.

    Decided per row, so that copies under a repeated id or without one go as well, and different
    texts under one id stay: the nodes are 64-bit hashes of id and text. Of rows equal in both one
    stays, whichever it is; rows without words have no links and all stay.
    """
    key = F.xxhash64(F.col("doc_id").cast("long"), "text")
    keyed = docs.select(key.alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    named = keyed.groupBy("row").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    joined = join_documents(docs.select(key.alias("doc_id"), "text"), threshold).filter("n_shingles > 0")
    rows = cut_lineage(joined.select(F.col("doc_id").alias("row"), F.col("component_id").alias("group")).distinct().join(named, "row"))
    first = rows.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("kept"))
    gone = rows.join(first, "group").filter("row != kept").select(F.col("row").alias("_row"))
    left = docs.withColumn("_row", key).join(gone, "_row", "left_anti").select(*docs.columns, "_row")
    again = cut_lineage(rows.join(first, "group").filter("row = kept and copies > 1").select(F.col("row").alias("_row")))
    if not again.isEmpty():  # combined before the shuffle: a row copied often is one row a task
        left = left.join(again, "_row", "left_anti").unionByName(
            left.join(again, "_row", "left_semi").dropDuplicates(["_row"]))
    return left.select(*docs.columns)
