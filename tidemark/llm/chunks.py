"""Documents as chunks of word numbers: the shared ground of the tokenizer and the language model.

A chunk is a run of rows of one input partition holding at most ``CHARS`` characters (one row
at least). Inside it each distinct word has a number, in order of first appearance. Two tables
are derived from the same deterministic pass:

* ``dictionary``: the distinct words of each chunk, dealt into parts by a hash of the word, one
  packed row (chunk, part, words, numbers, counts) per chunk and part. All that is known of a
  word meets in its part; a word in every document is one entry per chunk, not one per
  occurrence. The number of parts follows the counted size of the texts.
* ``streams``: one row per chunk with the numbers of its words packed and compressed, and its
  documents' ids.

``chunk`` is a hash of the chunk's ids and texts, so a stream can only ever meet the dictionary
made of the same rows. Both passes must see the input rows in the same order, as file splits
give them; if they did not, streams would lack a dictionary and ``paired`` would raise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import give_back, id_text, ids_of, small_batches

CHARS = 1 << 23

DICTIONARY = "chunk long, part int, words binary, numbers binary, counts binary"
STREAMS = "chunk long, doc_ids binary, id_null binary, flags binary, lengths binary, numbers binary"


def pack(numbers: np.ndarray) -> bytes:
    """Non-negative integers, byte planes compressed."""
    width = max(1, (int(numbers.max()).bit_length() + 7) // 8) if len(numbers) else 1
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.compress(np.ascontiguousarray(planes).tobytes(), 3)


def unpack(blob: bytes) -> np.ndarray:
    width = blob[0]
    planes = np.frombuffer(zstandard.decompress(blob[1:]), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<i8").ravel()


def pack_words(words: list[bytes]) -> bytes:
    sizes = pack(np.fromiter(map(len, words), np.int64, len(words)))
    return len(sizes).to_bytes(4, "little") + sizes + zstandard.compress(b"".join(words), 3)


def unpack_words(blob: bytes) -> list[bytes]:
    n = int.from_bytes(blob[:4], "little")
    ends = np.cumsum(unpack(blob[4: 4 + n])).tolist()
    flat = zstandard.decompress(blob[4 + n:])
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


def _rows(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(id_text("doc_id").alias("doc_id"), "text", "flag")


def parts_for(docs: DataFrame) -> int:
    """Parts of the dictionary: so many that what one holds is bounded, whatever the input."""
    return max(64, int(docs.agg(F.sum(F.length("text"))).first()[0] or 0) // CHARS)


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
    held, size = [], 0
    for pdf in batches:
        for row in zip(pdf["doc_id"], pdf["text"], pdf["flag"]):
            n = len(row[1] or "")
            if held and size + n > CHARS:
                yield held
                held, size = [], 0
            held.append(row)
            size += n
    if held:
        yield held


def _numbered(rows: list[tuple], split: Callable[[str | None], list], flagged_only: bool):
    """chunk id, word -> no, counts, and each document's word numbers."""
    h, nos, numbers = xxhash.xxh3_64(), {}, []
    for doc_id, text, _ in rows:
        h.update(f"{doc_id}\0{len(text or '')}\0")
        h.update((text or "").encode("utf-8", "surrogatepass"))
        words = split(text)
        numbers.append(np.fromiter((nos.setdefault(w, len(nos)) for w in words), np.int64, len(words)))
    chunk = int(np.uint64(h.intdigest()).astype(np.int64))
    taught = [x for x, (_, _, flag) in zip(numbers, rows) if flag or not flagged_only]
    counts = np.bincount(np.concatenate([*taught, np.empty(0, np.int64)]), minlength=len(nos))
    return chunk, nos, counts, numbers


def dictionary(docs: DataFrame, split: Callable, flagged_only: bool = False) -> DataFrame:
    """docs (doc_id, text, flag): the distinct words of each chunk, with their counts (over
    flagged rows alone where asked for)."""
    parts = parts_for(docs)

    def run(batches):
        for rows in _chunks(batches):
            chunk, nos, counts, _ = _numbered(rows, split, flagged_only)
            words = [w if isinstance(w, bytes) else w.encode("utf-8", "surrogatepass") for w in nos]
            nos.clear()
            part = np.fromiter((xxhash.xxh3_64_intdigest(w) % parts for w in words), np.int64, len(words))
            by = np.argsort(part, kind="stable")
            edges = np.flatnonzero(np.r_[True, part[by][1:] != part[by][:-1]]) if len(by) else by
            out = []
            for own in np.split(by, edges[1:]) if len(by) else ():
                at = np.array(sorted(own.tolist(), key=words.__getitem__))
                out.append((chunk, int(part[at[0]]), pack_words([words[i] for i in at]), pack(at), pack(counts[at])))
            yield pd.DataFrame(out, columns=["chunk", "part", "words", "numbers", "counts"])
            del words, part, by, out, counts
            give_back()

    return _rows(docs).mapInPandas(run, DICTIONARY)


def by_word(words: DataFrame, work: Callable, schema: str) -> DataFrame:
    """work(list of (words, counts) per chunk) -> one tuple of packed columns per chunk, called
    with all chunks' entries of one part; gives (chunk, numbers, <schema>)."""
    names = [f.split()[0] for f in schema.split(",")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        got = work([(unpack_words(w), unpack(c)) for w, c in zip(pdf["words"], pdf["counts"])])
        res = pd.DataFrame(got, columns=names)
        res.insert(0, "numbers", pdf["numbers"].to_numpy())
        res.insert(0, "chunk", pdf["chunk"].to_numpy())
        give_back()
        return res

    return words.groupBy("part").applyInPandas(run, f"chunk long, numbers binary, {schema}")


def streams(docs: DataFrame, split: Callable, as_set: bool = False) -> DataFrame:
    """docs (doc_id, text, flag): one packed row per chunk (numbers in order of appearance;
    sorted within a document with ``as_set``, where only how often a word occurs matters)."""
    def run(batches):
        for rows in _chunks(batches):
            chunk, _, _, numbers = _numbered(rows, split, False)
            ids = ids_of(r[0] for r in rows)
            null, put = ids.isna().astype(np.uint8), ids.to_numpy("<i8", na_value=0)
            if as_set:
                numbers = [np.sort(x) for x in numbers]
            yield pd.DataFrame({
                "chunk": [chunk], "doc_ids": [put.tobytes()], "id_null": [null.tobytes()],
                "flags": [np.array([bool(r[2]) for r in rows], np.uint8).tobytes()],
                "lengths": [np.array([len(x) for x in numbers], "<i8").tobytes()],
                "numbers": [pack(np.concatenate(numbers))]})
            del rows, numbers
            give_back()

    return _rows(docs).mapInPandas(run, STREAMS)


def paired(chunk_streams: DataFrame, words: DataFrame, gather: Callable, work: Callable, schema: str) -> DataFrame:
    """Joins each chunk's stream with its dictionary and applies
    work(doc_ids, flags, lengths, numbers, known) -> DataFrame, where
    known = gather(dictionary rows, their word numbers in the rows' order).

    A group is one chunk, whose size is bounded, whatever the input's.
    """
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty:
            raise RuntimeError("a chunk's words without its stream: the input rows came in another order")
        out = []
        right = right.drop_duplicates("numbers")  # equal chunks have equal rows
        at = np.concatenate([np.empty(0, np.int64), *map(unpack, right["numbers"])])
        if len(at) and (len(np.unique(at)) != len(at) or at.max() != len(at) - 1):
            raise RuntimeError("a chunk's words are not whole")
        known = gather(right, at)
        for row in left.itertuples(index=False):
            numbers, lengths = unpack(row.numbers), np.frombuffer(row.lengths, "<i8")
            if len(numbers) and int(numbers.max()) >= len(at):
                raise RuntimeError("a chunk's stream without its words: the input rows came in another order")
            ids = pd.array(np.frombuffer(row.doc_ids, "<i8").copy(), "Int64")
            ids[np.frombuffer(row.id_null, np.uint8).astype(bool)] = pd.NA
            out.append(work(ids, np.frombuffer(row.flags, np.uint8).astype(bool), lengths, numbers, known))
        give_back()
        return pd.concat(out, ignore_index=True)

    return chunk_streams.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInPandas(run, schema)
