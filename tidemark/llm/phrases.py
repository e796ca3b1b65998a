"""Phrase collocations: Rabin-Karp fingerprints of all n-grams, verified against the text.

1. Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and into words. Pieces are
   gathered into chunks of ``CHUNK`` words; a phrase never spans pieces, so a long text may lie in
   several chunks. Prefix polynomials over the word hashes give the fingerprint of every n-gram of
   a chunk with a few array operations; language and length are mixed in. Each chunk sends its
   distinct fingerprints with their counts, one packed block per fingerprint range, and once its words as a
   packed stream: the occurrences that the block's entries point to.
2. A range adds up the blocks of all chunks and sends each chunk those of its fingerprints that
   reach the minimum. Fingerprints are cut to as many bits as the input's size calls for
   (``fingerprint_bits``): a collision can only let a rare phrase through here, never lose one.
3. The chunk verifies: it finds the occurrences of these fingerprints, groups them by the words
   themselves, and only now writes phrases out, with their exact counts, again one packed row per
   part. Their sums over the chunks are exact, and those under the minimum go.
4. Scores, cuts and containment are joins and aggregations of the frequent phrases, which are at
   most ``longest / minimum`` of the words. Numbers are decimals of 38 digits.

A word in every text is one entry per chunk, so no key is hot; a group is one fingerprint range or
one chunk, both of bounded size whatever the input (a piece longer than ``CHUNK`` words, text
without a single mark or line end, is a chunk of its own). Null texts are empty, a null language is
``und``; other columns, ids among them, are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.chunks import pack, pack_words, unpack, unpack_words
from tidemark.llm.scratch import stored
from tidemark.llm.words import mix

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
CHUNK = 1 << 20  # words
RANGE_CHARS = 1 << 22  # of text for each range of fingerprints
LEAST_BITS = 32
MANY_LANGS = 10_000  # so many word totals are broadcast at most
UND = "und"

_U = np.uint64
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9)

_BLOCK = "chunk long, part int, prints binary, counts binary, words binary, numbers binary, sizes binary, langs binary, names binary"
_COLUMNS = [c.split()[0] for c in _BLOCK.split(", ")]


def pieces_of(text: str | None) -> list[list[bytes]]:
    """The words of each non-empty piece."""
    if not text:
        return []
    return [w for w in map(bytes.split, text.encode("utf-8", "surrogatepass").translate(_FOLD).split(b"\n")) if w]


def fingerprint_bits(chars: int) -> int:
    """Bits for a text of so many characters: a few fingerprints for each n-gram there can be."""
    return min(62, max(LEAST_BITS, int(chars).bit_length() + 2))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, _U)
    if n > 1:
        out[1:] = _U(base)
        np.multiply.accumulate(out, out=out)
    return out


class _Chunk:
    """Words of consecutive pieces as numbers, with the language of each piece."""

    def __init__(self, words: list[bytes], numbers: np.ndarray, sizes: np.ndarray, langs: np.ndarray, names: list[bytes]):
        self.words, self.numbers, self.sizes, self.langs, self.names = words, numbers, sizes, langs, names
        ends = np.repeat(np.cumsum(sizes), sizes)
        self.room = ends - np.arange(len(numbers))  # words from each place to its piece's end
        self.lang = np.repeat(langs, sizes)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))
        self.prefix = np.zeros(len(numbers) + 1, _U)
        np.cumsum(hashes[numbers] * _powers(_BASE, len(numbers)), out=self.prefix[1:])
        self.back = _powers(_INVERSE, len(numbers))
        self.seeds = mix(np.fromiter(map(xxhash.xxh3_64_intdigest, names), _U, len(names)))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places at which n words follow inside a piece, and their 64-bit fingerprints."""
        at = np.flatnonzero(self.room >= n)
        value = (self.prefix[at + n] - self.prefix[at]) * self.back[at]
        return at, mix(value + self.seeds[self.lang[at]] * _U(2 * n + 1))


def _chunks(batches):
    words, sizes, langs, codes, held = [], [], [], {}, 0

    def flush():
        nos: dict[bytes, int] = {}
        numbers = np.fromiter((nos.setdefault(w, len(nos)) for piece in words for w in piece), np.int64, held)
        return _Chunk(list(nos), numbers, np.array(sizes, np.int64), np.array(langs, np.int64), [x.encode("utf-8", "surrogatepass") for x in codes])

    for pdf in batches:
        for lang, text in zip(pdf["lang"], pdf["text"]):
            for piece in pieces_of(text):
                words.append(piece)
                sizes.append(len(piece))
                langs.append(codes.setdefault(lang, len(codes)))
                held += len(piece)
                if held >= CHUNK:
                    yield flush()
                    words, sizes, langs, codes, held = [], [], [], {}, 0
    if held:
        yield flush()


def _fingerprints(bits: int, ranges: int, longest: int):
    cut = _U(64 - bits)
    edges = [_U(-(-(p << bits) // ranges)) for p in range(1, ranges)]

    def run(batches):
        for chunk in _chunks(batches):
            prints = np.concatenate([chunk.grams(n)[1] >> cut for n in range(1, longest + 1)])
            prints.sort()
            first = np.flatnonzero(np.r_[True, prints[1:] != prints[:-1]])
            counts = np.diff(np.append(first, len(prints)))
            prints = prints[first]
            stream = {"words": pack_words(chunk.words), "numbers": pack(chunk.numbers), "sizes": pack(chunk.sizes),
                      "langs": pack(chunk.langs), "names": pack_words(chunk.names)}
            name = xxhash.xxh3_64(b"".join(stream.values())).intdigest()
            name = int(_U(name).astype(np.int64))
            out = [{"chunk": name, "part": ranges + name % ranges, "prints": None, "counts": None} | stream]
            for p, (own, n) in enumerate(zip(np.split(prints, at := np.searchsorted(prints, edges)), np.split(counts, at))):
                if len(own):
                    out.append({"chunk": name, "part": p, "prints": pack(np.diff(own.astype(np.int64), prepend=0)),
                                "counts": pack(n)} | dict.fromkeys(stream))
            yield pd.DataFrame(out, columns=_COLUMNS)
    return run


def _prints(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob))


def _frequent(minimum: int):
    """One range: of each chunk's fingerprints those whose counts reach the minimum together."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["numbers"].iloc[0] is not None:
            return pdf  # the chunks' streams pass
        blocks = [_prints(b) for b in pdf["prints"]]
        every = np.concatenate(blocks)
        by = np.argsort(every, kind="stable")
        every, counts = every[by], np.concatenate([unpack(c) for c in pdf["counts"]])[by]
        first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        keep = every[first][np.add.reduceat(counts, first) >= minimum]
        out = []
        for row, own in zip(pdf.itertuples(index=False), blocks):
            if len(keep):
                own = own[keep[np.minimum(np.searchsorted(keep, own), len(keep) - 1)] == own]
                if len(own):
                    out.append({"chunk": row.chunk, "part": row.part, "prints": pack(np.diff(own, prepend=0))})
        return pd.DataFrame(out, columns=_COLUMNS)
    return run


def _alike(chunk: _Chunk, at: np.ndarray, prints: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A place, the fingerprint and the number of occurrences of each phrase of n words among the
    places ``at``; equal words decide, the fingerprints only bring them together."""
    by = np.argsort(prints, kind="stable")
    at, prints = at[by], prints[by]
    first = np.flatnonzero(np.r_[True, prints[1:] != prints[:-1]]) if len(at) else np.empty(0, np.int64)
    counts = np.diff(np.append(first, len(at)))
    head = np.repeat(at[first], counts)
    same = chunk.lang[at] == chunk.lang[head]
    for k in range(n):
        same &= chunk.numbers[at + k] == chunk.numbers[head + k]
    if not same.all():
        grid = np.stack([chunk.lang[at], *(chunk.numbers[at + k] for k in range(n))], 1)
        _, first, counts = np.unique(grid, axis=0, return_index=True, return_counts=True)
    return at[first], prints[first], counts


def _verified(bits: int, parts: int, longest: int):
    """One chunk: its occurrences of frequent fingerprints as phrases with exact counts, dealt by
    fingerprint; the words of each language in all count as the phrase without words."""
    cut = _U(64 - bits)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keep = np.concatenate([np.empty(0, np.int64), *map(_prints, pdf["prints"].dropna())])
        keep = np.unique(keep)
        sieve = np.zeros(1 << 22, bool)
        sieve[keep & (len(sieve) - 1)] = True
        out = []
        for row in pdf[pdf["numbers"].notna()].itertuples(index=False):
            chunk = _Chunk(unpack_words(row.words), unpack(row.numbers), unpack(row.sizes), unpack(row.langs), unpack_words(row.names))
            phrases, counts = [x + b"\n" for x in chunk.names], [np.bincount(chunk.lang, minlength=len(chunk.names))]
            part = [(chunk.seeds % _U(parts)).astype(np.int64)]
            for n in range(1, longest + 1):
                at, full = chunk.grams(n)
                short = (full >> cut).astype(np.int64)
                hit = np.flatnonzero(sieve[short & (len(sieve) - 1)])
                own = short[hit]
                hit = hit[keep[np.minimum(np.searchsorted(keep, own), len(keep) - 1)] == own] if len(keep) else hit[:0]
                at, prints, f = _alike(chunk, at[hit], full[hit], n)
                grid = np.stack([chunk.numbers[at + k] for k in range(n)], 1).tolist()
                phrases += [chunk.names[x] + b"\n" + b" ".join([chunk.words[i] for i in g])
                            for x, g in zip(chunk.lang[at].tolist(), grid)]
                counts.append(f)
                part.append((prints % _U(parts)).astype(np.int64))
            part, counts = np.concatenate(part), np.concatenate(counts)
            by = np.argsort(part, kind="stable")
            edges = np.flatnonzero(np.r_[True, part[by][1:] != part[by][:-1]])
            for own in np.split(by, edges[1:]):
                out.append((int(part[own[0]]), pack_words([phrases[i] for i in own.tolist()]), pack(counts[own])))
        return pd.DataFrame(out, columns=["part", "phrases", "counts"])
    return run


def _summed(minimum: int):
    """One part: the counts of all chunks added up, those under the minimum left out."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        total: dict[bytes, int] = {}
        for phrases, counts in zip(pdf["phrases"], pdf["counts"]):
            for phrase, n in zip(unpack_words(phrases), unpack(counts).tolist()):
                total[phrase] = total.get(phrase, 0) + n
        out = []
        for key, n in total.items():
            lang, phrase = key.rsplit(b"\n", 1)  # no phrase holds a line end
            if n >= minimum or not phrase:
                out.append((lang.decode("utf-8", "surrogatepass"), phrase.count(b" ") + 1 if phrase else 0,
                            phrase.decode("utf-8", "surrogatepass"), n))
        return pd.DataFrame(out, columns=["lang", "size", "phrase", "f"])
    return run


def frequent_phrases(docs: DataFrame, minimum: int = MIN_COUNT, longest: int = LONGEST) -> DataFrame:
    """(lang, size, phrase, f): every phrase of up to ``longest`` words with f >= minimum
    occurrences in its language; size 0 holds the number of all words of a language."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UND)).alias("lang"), "text")
    chars = int(texts.agg(F.sum(F.length("text"))).first()[0] or 0)
    bits, ranges = fingerprint_bits(chars), max(64, chars // RANGE_CHARS)
    blocks = texts.mapInPandas(_fingerprints(bits, ranges, longest), _BLOCK)
    kept = blocks.groupBy("part").applyInPandas(_frequent(minimum), _BLOCK)
    found = kept.groupBy("chunk").applyInPandas(_verified(bits, ranges, longest), "part int, phrases binary, counts binary")
    return found.groupBy("part").applyInPandas(_summed(minimum), "lang string, size int, phrase string, f long")


def _joined(start: Column | int, count: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), start, count), " ")


def _outside_longer(phrases: DataFrame) -> DataFrame:
    """Candidates that occur outside of every longer candidate. A longer one with as many
    occurrences implies one that is a single word longer with as many, so its two parts do."""
    size = F.col("size")
    own = phrases.filter("size >= 2").select("lang", "phrase", "size", F.col("f").alias("a"), F.lit(None).cast("long").alias("longer"))
    parts = phrases.filter("size >= 3").withColumn("start", F.explode(F.array(F.lit(1), F.lit(2))))
    parts = parts.select("lang", _joined(F.col("start"), size - 1).alias("phrase"), (size - 1).alias("size"),
                         F.lit(None).cast("long").alias("a"), F.col("f").alias("longer"))
    both = own.unionByName(parts).groupBy("lang", "phrase", "size").agg(F.max("a").alias("a"), F.max("longer").alias("longer"))
    return both.filter("a is not null and (longer is null or longer < a)").select("lang", "phrase", "size", "a")


def collocations(docs: DataFrame, minimum: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to ``longest``
    words by score, then a, descending, then phrase. The score is floor(1000 * a * n / (l * r)) of
    the cut into two parts (occurring l and r times) with the lowest score, the earliest of equals."""
    phrases = stored(frequent_phrases(docs, minimum, longest))
    totals = phrases.filter("size = 0").select("lang", F.col("f").alias("n"))
    if totals.count() <= MANY_LANGS:
        totals = F.broadcast(totals)
    parts = phrases.filter("size >= 1 and size < %d" % longest)
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    cuts = _outside_longer(phrases).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("first", _joined(1, F.col("k"))).withColumn("rest", _joined(F.col("k") + 1, F.col("size") - F.col("k")))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    score = F.expr("(cast(1000 as decimal(38,0)) * a * n) div (cast(l as decimal(38,0)) * r)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (scored.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


# DuckDB SQL for the rows of ``collocations`` over the view ``documents``.
SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
sized AS (SELECT lang, w, unnest(range(1, 6)) AS size FROM worded),
placed AS (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM sized WHERE len(w) >= size),
f AS (SELECT lang, size, w[i : i + size - 1] AS g, count(*)::BIGINT AS f FROM placed GROUP BY ALL HAVING count(*) >= 100),
longer AS (
  SELECT lang, g, max(f) AS most FROM (
    SELECT lang, g[1 : size - 1] AS g, f FROM f WHERE size >= 3
    UNION ALL SELECT lang, g[2 : size], f FROM f WHERE size >= 3) GROUP BY lang, g),
candidates AS (
  SELECT f.lang, f.size, f.g, f.f AS a FROM f LEFT JOIN longer USING (lang, g)
  WHERE f.size >= 2 AND (most IS NULL OR 100 * most < 100 * f.f)),
cuts AS (
  SELECT c.lang, c.g, c.a, k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN f x ON x.lang = c.lang AND x.g = c.g[1 : k]
  JOIN f y ON y.lang = c.lang AND y.g = c.g[k + 1 : c.size]
  JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS o FROM cuts),
scored AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM lowest WHERE o = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM scored)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
