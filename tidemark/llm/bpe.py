"""Byte-level BPE over whole texts: each distinct word of the corpus is encoded once.

1. Texts are cut into pre-tokens; per chunk of documents (see ``chunks``) each distinct one is
   one entry, so a frequent pre-token crosses the shuffle once per chunk.
2. The global shuffle by pre-token (hashed into parts, entries packed) brings equal ones
   together; each is encoded once by its merge ranks, and the ids go back to the chunks.
3. Documents are reassembled by position. Decoding joins the ids with the token-byte table (as
   many rows as the vocabulary) at the level of distinct pre-tokens and reassembles alike.

Null and empty texts have no tokens; the digests are then those of the empty string.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import chunks
from tidemark.llm.rows import id_text, ids_of

RANKS = "byte_bpe_50k.tiktoken"


def vocabulary(path: str | None = None) -> tuple[dict[bytes, int], str]:
    """Ranks and splitting pattern of a public tokenizer (``path``: a rank file)."""
    import public_tokenizers as public
    with open(path or public.path(RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return ranks, public.PATTERN


@lru_cache(4)
def _coder(path: str | None):
    ranks, pattern = vocabulary(path)
    return tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}), ranks, pattern


@lru_cache(4)
def splitter(path: str | None = None):
    # \s means White_Space in the tokenizer's pattern language; Python's class has four more characters
    pattern = _coder(path)[2].replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(
        r"\S", r"\P{White_Space}")
    find = regex.compile(pattern).findall
    return lambda text: find(text) if text else []


def encode_words(words: DataFrame, path: str | None = None) -> DataFrame:
    """A dictionary (see ``chunks``) -> (chunk, numbers, sizes, ids): equal words share one encoding."""
    def work(entries):
        single, memo, out = _coder(path)[0]._encode_single_piece, {}, []
        for words, _ in entries:
            ids = []
            for w in words:
                got = memo.get(w)
                if got is None:
                    got = memo[w] = single(w)
                ids.append(got)
            flat = np.fromiter((i for x in ids for i in x), np.int64)
            out.append((chunks.pack(np.fromiter(map(len, ids), np.int64, len(ids))), chunks.pack(flat)))
        return out

    return chunks.by_word(words, work, "sizes binary, ids binary")


def _gather(rows: pd.DataFrame, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and size of each word's ids, by word number, in one array of ids."""
    own = np.concatenate([np.empty(0, np.int64), *map(chunks.unpack, rows["sizes"])])
    flat = np.concatenate([np.empty(0, np.int64), *map(chunks.unpack, rows["ids"])])
    sizes, starts = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    sizes[at], starts[at] = own, np.cumsum(own) - own
    return starts, sizes, flat.astype("<u4")


def token_bytes(spark, path: str | None = None) -> DataFrame:
    """The token-byte table (id, bytes): one row per entry of the vocabulary."""
    ranks, _ = vocabulary(path)
    return spark.createDataFrame(pd.DataFrame({"id": list(ranks.values()), "bytes": list(ranks)}), "id long, bytes binary")


def _pick(starts: np.ndarray, sizes: np.ndarray, numbers: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` named by ``numbers`` one after another, and their ends."""
    n = sizes[numbers]
    ends = np.cumsum(n)
    at = np.repeat(starts[numbers] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)
    return flat[at], ends


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids binary) per document: ids as little-endian unsigned 32-bit integers."""
    return _assemble(docs, path, digests=False)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per document."""
    return _assemble(docs, path, digests=True)


def _assemble(docs: DataFrame, path: str | None, digests: bool) -> DataFrame:
    spark = docs.sparkSession
    flagged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(True).alias("flag"))

    def split(text):
        return splitter(path)(text)

    coded = encode_words(chunks.dictionary(flagged, split), path)
    table = spark.sparkContext.broadcast(_token_table(token_bytes(spark, path)) if digests else None)

    def work(ids, _, lengths, numbers, known):
        starts, sizes, flat = known
        if digests:  # bytes of each distinct word by joining its ids with the token-byte table
            tok_start, tok_size, tok_flat = table.value
            raw, ends = _pick(tok_start, tok_size, flat, tok_flat)
            place = np.append(0, ends)
            raw_start, raw_size = place[starts], place[starts + sizes] - place[starts]
        out, at = [], 0
        for n in lengths:
            own = numbers[at: at + n]
            at += n
            got = _pick(starts, sizes, own, flat)[0] if n else flat[:0]
            row = [len(got)]
            if digests:
                back = _pick(raw_start, raw_size, own, raw)[0] if n else raw[:0]
                row += [hashlib.sha256(got.tobytes()).hexdigest(), hashlib.sha256(back.tobytes()).hexdigest()]
            else:
                row += [got.tobytes()]
            out.append(row)
        cols = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["n_tokens", "ids"]
        res = pd.DataFrame(out, columns=cols)
        res.insert(0, "doc_id", ids)
        return res

    schema = "doc_id long, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids binary")
    return chunks.paired(chunks.streams(flagged, split), coded, _gather, work, schema)


def _token_table(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and size of each id's bytes in one array (as long as the vocabulary file)."""
    pdf = rows.toPandas()
    size = np.zeros(int(pdf["id"].max()) + 1 if len(pdf) else 1, np.int64)
    size[pdf["id"]] = [len(x) for x in pdf["bytes"]]
    by_id = pdf.sort_values("id")["bytes"]
    return np.cumsum(size) - size, size, np.frombuffer(b"".join(by_id), np.uint8)


def decode(ids: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids binary) -> (doc_id, decoded binary), by the token-byte table."""
    table = ids.sparkSession.sparkContext.broadcast(_token_table(token_bytes(ids.sparkSession, path)))

    def run(batches):
        start, size, flat = table.value
        for pdf in batches:
            got = [None if x is None else _pick(start, size, np.frombuffer(x, "<u4"), flat)[0].tobytes() for x in pdf["ids"]]
            yield pd.DataFrame({"doc_id": ids_of(pdf["doc_id"]), "decoded": got})

    return ids.select(id_text("doc_id").alias("doc_id"), "ids").mapInPandas(run, "doc_id long, decoded binary")
