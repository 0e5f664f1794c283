"""Token ids of a public tokenizer, written as flat binary files with 64-bit document offsets.

A range of ids makes three files: part-N.bin (unsigned little-endian ids of all its documents, end
to end, 16 bits wide if the vocabulary allows), part-N.idx (int64 offsets, one more than it has
documents) and part-N.doc (int64 document ids; null ids come first and are counted in the part's
row). Ranges ascend with the part number, so a part's base is a prefix sum over the parts. Files
are written under a new name and then renamed: a repeated task attempt replaces them by the same.
"""

import string
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import batched

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounds, range_key, range_of, shared_dir

#: Bytes of chunks and ids that an encoder remembers; beyond that only the first quarter stays (memory
#: only, not results). ENTRY, EACH: what a chunk takes, and each of its characters with its ids at most.
MEMORY, ENTRY, EACH = 165_000_000, 210, 8
#: Documents a file holds, about: files of some tens of MB, and no swarm of short tasks.
ROWS = 16_000
#: What shows whether a tokenizer's ids are those of its chunks end to end.
PROBES = ("a b", " a", "a ", "a  b", "a\nb", "a \n b.", "It's 1,234.5 (x) done", "Été 漢字 ñ", "x\t y\r\nz", "don't 'll !? ... <a b>", "e\u0301 \u0301 a", "\U0001f600 \U0001f600\u200d b", "")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of whole texts by the tokenizers library, without special tokens of its own.

    A vocabulary with word-end tokens whose splitter ends every token at white space gives a text the
    ids of its chunks between plain spaces and line ends, end to end; ids of chunks seen before are
    remembered. Chunks of letters only are encoded many at a time and cut at word-end tokens. Whether
    a vocabulary is so is tried on PROBES when it is loaded; others encode every text by itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 65536 else "<u4")
        self.ends = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.known: dict[str, bytes] = {"": b""}
        self.held = 0
        self.marks: dict[str, bytes] = {}
        self.by_chunk = bool(self.ends.any()) and all(self._ids(p) == b"".join(map(self._ids, self._chunks(p))) for p in PROBES)

    @staticmethod
    def _chunks(text: str) -> list[str]:
        return text.replace("\n", " ").split(" ")

    def _ids(self, text: str) -> bytes:
        ids = array("H" if self.dtype.itemsize == 2 else "I", self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _learn(self, new: set[str]) -> None:
        known, marks, wide = self.known, self.marks, self.dtype.itemsize
        # Words of letters, and words with marks after them: their ids are the word's, then the marks'.
        plain, ends = [], []
        for c in new:
            word = c.rstrip(string.punctuation)
            if word.isalpha():
                plain.append(word)
                if len(word) < len(c):
                    ends.append((c, word, c[len(word) :]))
        words = list(set(plain).difference(known))
        if len(marks) > 10_000:
            marks.clear()
        for m in {m for _, _, m in ends}.difference(marks):
            marks[m] = self._ids(m)
        for i in range(0, len(words), 2000):
            some = words[i : i + 2000]
            ids = self._ids(" ".join(some))
            cut = ((np.flatnonzero(self.ends[np.frombuffer(ids, self.dtype)]) + 1) * wide).tolist()
            if len(cut) == len(some) and cut[-1] == len(ids):
                known.update(zip(some, [ids[a:b] for a, b in zip([0, *cut], cut)]))
            else:
                known.update((word, self._ids(word)) for word in some)
        known.update([(c, known[word] + marks[m]) for c, word, m in ends])
        known.update([(c, self._ids(c)) for c in new.difference(known)])

    def encode(self, text: str | None) -> bytes:
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str | None], at_once: int = 12) -> Iterator[bytes]:
        """Ids of each text as bytes of self.dtype."""
        for some in batched(texts, at_once):
            if not self.by_chunk:
                yield from (self._ids(t or "") for t in some)
                continue
            chunks = [self._chunks(t or "") for t in some]
            new = set().union(*chunks).difference(self.known)
            if new:
                if self.held + ENTRY * len(new) + EACH * sum(map(len, new)) > MEMORY:  # the first words seen are mostly the common ones
                    self._forget()
                    new = set().union(*chunks).difference(self.known)
                before = len(self.known)
                self._learn(new)  # chunks, and the words in them
                self.held += ENTRY * (len(self.known) - before) + EACH * sum(map(len, new))
            for c in chunks:
                yield b"".join(map(self.known.__getitem__, c))

    def _forget(self) -> None:
        kept, self.held = {"": b""}, 0
        for c, ids in self.known.items():
            self.held += ENTRY + EACH * len(c)
            if self.held > MEMORY // 4:
                break
            kept[c] = ids
        self.known = kept


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a path and Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def rested() -> None:
    """Lets this worker's encoders forget all but the common words, when all texts are encoded."""
    for one in _encoders.values():
        one._forget()


def _place(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def _read(path: str, dtype: str) -> np.ndarray:
    where, name = _place(path)
    if where.get_file_info(name).size == 0:
        return np.empty(0, dtype)
    if isinstance(where, fs.LocalFileSystem):
        return np.memmap(name, dtype, mode="r")
    with where.open_input_file(name) as f:
        return np.frombuffer(f.read_buffer(), dtype)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every whole text, appends end_id to each, and writes the files under path.

    Documents come in ascending id order, null ids first (by a hash of their text), equal ids by their
    token ids. Null text counts as empty: the end id alone; long texts are encoded whole. Returns the parts: (part, n_docs, n_tokens, n_null, base,
    path, dtype), base being the number of ids in all parts before. Empty input writes nothing.
    """
    spark = docs.sparkSession
    id_ = F.col(id_col).cast("long")
    rows = docs.select(range_key(id_, F.coalesce(text_col, F.lit(""))).alias("key"), F.coalesce(id_, F.lit(0)).alias("id"), id_.isNull().alias("no_id"), F.col(text_col).alias("text"))
    cuts = bounds(rows, "key", rows_each=ROWS)
    rows = rows.withColumn("part", range_of(F.col("key"), cuts))
    dtype = encoder(tokenizer).dtype.str

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer)
        tail = np.array([end_id], enc.dtype).tobytes()
        for pdf in batches:
            for i in range(0, len(pdf), 1000):
                some = pdf.iloc[i : i + 1000]
                yield some[["part", "key", "id", "no_id"]].assign(ids=[b + tail for b in enc.encode_all(some["text"])])

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rested()
        part, lengths, keys, n_null = None, [], [], 0
        where, top = _place(path)
        where.create_dir(top, recursive=True)
        fresh = f"{top}/.{uuid.uuid4().hex}"
        with where.open_output_stream(f"{fresh}.bin") as out:
            for pdf in batches:
                if not len(pdf):
                    continue
                part = int(pdf["part"].iloc[0])
                out.write(b"".join(pdf["ids"]))
                lengths.append(pdf["ids"].str.len().to_numpy(np.int64))
                keys.append(pdf["id"].to_numpy(np.int64))
                n_null += int(pdf["no_id"].sum())
        if part is None:
            where.delete_file(f"{fresh}.bin")
            return
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths) // np.dtype(dtype).itemsize)]).astype("<i8")
        for kind, data in (("idx", offsets), ("doc", np.concatenate(keys).astype("<i8"))):
            with where.open_output_stream(f"{fresh}.{kind}") as out:
                out.write(data.tobytes())
        for kind in ("bin", "idx", "doc"):
            where.move(f"{fresh}.{kind}", f"{top}/part-{part:06d}.{kind}")
        yield pd.DataFrame({"part": [part], "n_docs": [len(offsets) - 1], "n_tokens": [int(offsets[-1])], "n_null": [n_null]})

    coded = rows.mapInPandas(encode, "part int, key long, id long, no_id boolean, ids binary")
    coded = coded.repartitionById(max(1, len(cuts)), F.col("part")).sortWithinPartitions(F.desc("no_id"), "key", "id", "ids")
    coded.mapInPandas(write, "part int, n_docs long, n_tokens long, n_null long").write.parquet(f"{path}/parts")
    parts = spark.read.schema("part int, n_docs long, n_tokens long, n_null long").parquet(f"{path}/parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    return parts.select("*", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"), F.lit(path).alias("path"), F.lit(dtype).alias("dtype"))


def read_tokens(parts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, start, n_tokens, ids_crc32) per document, from the files alone, memory-mapped."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rested()
        for pdf in batches:
            for r in pdf.itertuples():
                name = f"{r.path}/part-{r.part:06d}"
                ids, offsets, keys = _read(f"{name}.bin", r.dtype), _read(f"{name}.idx", "<i8"), _read(f"{name}.doc", "<i8")
                for i in range(0, len(keys), 1000):
                    at = offsets[i : i + 1001]
                    crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                    out = pd.DataFrame({id_col: pd.array(keys[i : i + 1000].copy(), "Int64"), "start": r.base + at[:-1], "n_tokens": np.diff(at), "ids_crc32": np.array(crc, np.int64)})
                    out.loc[np.arange(i, i + len(crc)) < r.n_null, id_col] = pd.NA
                    yield out

    # A task a part: the table of parts is small, the files are not.
    n = max(1, int(parts.agg(F.max("part")).first()[0] or 0) + 1)
    return parts.repartitionById(n, F.col("part")).mapInPandas(read, f"{id_col} long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 2, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """write_tokens and then read_tokens; path: a folder that all executors share."""
    return read_tokens(write_tokens(docs, path or shared_dir(docs.sparkSession), tokenizer, end_id, id_col, text_col), id_col)
