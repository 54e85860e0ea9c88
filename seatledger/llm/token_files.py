"""Operator 9: token ids in flat files with 64-bit offsets, in document order.

Format, below one folder:

``part-NNNNN-*.ids``  token ids of the part's documents one after another, little-endian
                      unsigned, 16 bits wide when the vocabulary allows it, else 32
``part-NNNNN-*.idx``  per document three little-endian 64-bit integers: doc_id, offset of its
                      first id in the part, and 1 when the row has an id (0: doc_id is void);
                      a closing entry holds the part's length
``parts``             Parquet table (part, n_docs, n_ids, width, file, doc_base, id_base): the
                      name of the part's two files without their ending, and bases that are
                      prefix sums over the parts, so a document's place in the whole
                      collection is base plus offset

Parts are ranges of (doc_id, text) in ascending order, so many rows without id or of one id
spread over parts. Each attempt of a task writes files of its own name, and the table of
parts names those of the attempt whose row was committed: nothing is renamed or replaced,
and files that a lost attempt left are never read.
"""

from __future__ import annotations

import os
import string
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seatledger.llm.text import IS_SPACE, LOWERED, blocks, byte_column, word_spans
from seatledger.session import small_batches

END_ID = 1
#: Words whose ids a task remembers; later words are encoded again in every block.
REMEMBERED = 400_000
#: Characters of distinct words handed to the tokenizer at a time.
JOINED = 5_000
#: Bytes of text encoded at a time; a longer text is taken alone.
BLOCK = 2 << 20
#: Bytes of text in one part.
PART_BYTES = 64 << 20
#: Characters of a text that range bounds hold; whole texts would fill the driver with the sample.
BOUND_CHARS = 64

_IS_PLAIN = np.array([chr(k) in string.ascii_letters + string.digits for k in range(256)])
#: The apostrophe is no mark here: tokenizers look at the letters behind it.
_IS_MARK = np.array([chr(k) in string.punctuation and chr(k) != "'" for k in range(256)])

_PARTS = pa.schema([("part", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32()), ("file", pa.string())])
_FOUND = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


class WordEncoder:
    """Ids of texts whose tokenizer lower-cases and treats ASCII white space as a mere border.

    Arrow numbers the distinct words of a block, and what is done in Python is done once for
    each of these. Words not seen before are encoded many in one call, joined by blanks. Ids of
    the first ``REMEMBERED`` words are kept as rows of a ragged array. ``split_marks`` as in
    ``write_token_files``.
    """

    def __init__(self, path: str, split_marks: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.split_marks = Tokenizer.from_file(path), split_marks
        self.place: dict[bytes, int] = {}
        # Entry 0 is the closing id, words follow.
        self.ids, self.ends = np.zeros(1, np.uint32), np.arange(2, dtype=np.int64)

    def _encode(self, words: list[str], n_letters: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each has; the first ``n_letters`` hold letters alone."""
        ids, counts, lo = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], 0
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        borders = np.concatenate([[0], np.cumsum(sizes)])
        while lo < len(words):
            hi = int(np.searchsorted(borders, borders[lo] + JOINED, "left"))
            hi = min(hi, n_letters if lo < n_letters else len(words))
            done = self.tokenizer.encode(" ".join(words[lo:hi]), add_special_tokens=False)
            ids.append(np.array(done.ids, np.uint32))
            # Its own words split ours, never at letters unless normalizing makes marks of them: then there
            # are more. Offsets tell as well which ids belong to which word, but cost half as much as the encoding.
            word = done.word_ids if hi <= n_letters else []
            if word and word[-1] == hi - lo - 1:
                word = np.array(word, np.int64)
            else:
                at = np.fromiter((a for a, _ in done.offsets), np.int64, len(done.ids))
                word = np.searchsorted(borders[lo:hi] - borders[lo], at, "right") - 1
            counts.append(np.bincount(word, minlength=hi - lo))
            lo = hi
        return np.concatenate(ids), np.concatenate(counts)

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after another, each closed by ``end_id``; ids per text."""
        return self.encode_block(*byte_column(pa.array(texts, pa.large_string())), end_id)

    def encode_block(self, data: np.ndarray, borders: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts that stand in one array of bytes between ``borders``."""
        # The tokenizer lower-cases; doing it first halves the forms. Its special tokens are
        # looked for in the raw text, so a text that may hold one is left as it is.
        special = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
        raw, data = data, LOWERED[data]
        special = [slice(borders[row], borders[row + 1]) for row in np.unique(np.searchsorted(borders, special, "right") - 1)]
        for bytes_of_row in special:
            data[bytes_of_row] = raw[bytes_of_row]
        starts, stops, firsts = word_spans(data, borders)
        if self.split_marks:
            cut = np.zeros(len(data), bool)
            np.logical_and(_IS_PLAIN[data[:-1]], _IS_MARK[data[1:]], out=cut[1:])
            for bytes_of_row in special:
                cut[bytes_of_row] = False
            cut[borders[:-1][borders[:-1] < len(data)]] = False
            cut = np.flatnonzero(cut)
            starts = np.insert(starts, np.searchsorted(starts, cut), cut)
            stops = np.insert(stops, np.searchsorted(stops, cut), cut)
            firsts = np.searchsorted(starts, borders)
        offsets = np.concatenate([[0], np.cumsum(stops - starts)])
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[~IS_SPACE[data]])])
        words = words.dictionary_encode()
        forms = words.dictionary.to_numpy(zero_copy_only=False).tolist()

        entry = np.fromiter(map(self.place.get, forms, repeat(0)), np.int64, len(forms))
        new = np.flatnonzero(entry == 0)
        spelt = [forms[k].decode() for k in new]
        letters = np.fromiter(map(str.isalpha, spelt), bool, len(new))
        order = np.argsort(~letters, kind="stable")
        fresh, counts = self._encode([spelt[k] for k in order], int(letters.sum()))
        known = len(self.place)
        entry[new[order]] = np.arange(known + 1, known + 1 + len(new))
        self.ids[0] = end_id
        flat = np.concatenate([self.ids, fresh])
        ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
        kept = new[order][: max(0, REMEMBERED - known)].tolist()
        self.place.update(zip((forms[k] for k in kept), range(known + 1, known + 1 + len(kept)), strict=True))
        self.ends = ends[: known + len(kept) + 2]
        self.ids = flat[: self.ends[-1]]

        # The closing id stands behind each text as one more form.
        which = np.insert(words.indices.to_numpy().astype(np.int64), firsts[1:], len(forms))
        entry = np.append(entry, 0)
        lengths = (ends[entry + 1] - ends[entry])[which]
        last = np.cumsum(lengths)
        total = int(last[-1]) if len(last) else 0
        at = np.repeat(ends[entry][which] - (last - lengths), lengths)
        at += np.arange(total)
        words_before = firsts + np.arange(len(firsts))
        return flat[at], np.diff(np.concatenate([[0], last])[words_before])


@lru_cache(maxsize=1)
def _encoder(path: str, split_marks: bool) -> WordEncoder:
    """The encoder of this Python worker, with what earlier tasks have left in it."""
    return WordEncoder(path, split_marks)


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _writer(folder: str, tokenizer: str, end_id: int, width: int, keep_words: bool = True, split_marks: bool = False):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        store, root = _place(folder)
        name = f"part-{part:05d}-{uuid.uuid4().hex}"
        encoder, n_docs, n_ids = None, 0, 0
        ids_file = index_file = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if encoder is None:
                encoder = (_encoder if keep_words else WordEncoder)(tokenizer, split_marks)
                ids_file = store.open_output_stream(f"{root}/{name}.ids")
                index_file = store.open_output_stream(f"{root}/{name}.idx")
            doc_ids = batch.column("doc_id")
            there = doc_ids.is_valid().to_numpy(zero_copy_only=False)
            doc_ids = doc_ids.fill_null(0).to_numpy(zero_copy_only=False)
            for own, data, borders in blocks(batch.column("text"), BLOCK):
                ids, counts = encoder.encode_block(data, borders, end_id)
                ids_file.write(ids.astype(f"<u{width}").tobytes())
                rows = np.empty((len(counts), 3), "<i8")
                rows[:, 0], rows[:, 2] = doc_ids[own], there[own]
                rows[:, 1] = n_ids + np.cumsum(counts) - counts
                index_file.write(rows.tobytes())
                n_docs, n_ids = n_docs + len(counts), n_ids + int(counts.sum())
        if encoder is not None:
            index_file.write(np.array([0, n_ids, 0], "<i8").tobytes())
            ids_file.close()
            index_file.close()
            yield pa.record_batch([[part], [n_docs], [n_ids], [width], [name]], schema=_PARTS)

    return write


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, keep_words: bool = True, split_marks: bool = False) -> DataFrame:
    """Write (doc_id, text) in the format above; returns the table of parts with their bases.

    Ascending doc_id, rows without id first; ties are ordered by text. Null and empty texts
    hold the closing id alone. ``tokenizer`` is the path of a ``tokenizers`` file that
    lower-cases, drops no letters, and for which ASCII white space only separates. An empty table writes no part.
    ``keep_words``: Python workers keep the words' ids, up to 150 MB each, for later tasks; without,
    each task begins anew and leaves that memory to whatever the worker runs next.
    ``split_marks``: for tokenizers that never join an ASCII letter or digit with the ASCII punctuation
    behind it, apostrophes apart; a word's ids then serve before a comma or a full stop too.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    small_batches(spark)
    width = 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    store, root = _place(folder)
    store.create_dir(root, recursive=True)
    # Beginnings of texts are ordered as the texts are, so both sort orders agree at the borders.
    ranged = docs.select("doc_id", "text").repartitionByRange(parts, "doc_id", F.substring("text", 1, BOUND_CHARS))
    ordered = ranged.sortWithinPartitions("doc_id", "text")
    written = ordered.mapInArrow(_writer(folder, tokenizer, end_id, width, keep_words, split_marks), "part int, n_docs bigint, n_ids bigint, width int, file string")
    written.write.mode("overwrite").parquet(f"{folder}/sizes")
    # One row per part: the window over them all is over metadata.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (F.coalesce(F.sum(c).over(before), F.lit(0)).alias(b) for c, b in (("n_docs", "doc_base"), ("n_ids", "id_base")))
    spark.read.schema(written.schema).parquet(f"{folder}/sizes").select("*", *bases).write.mode("overwrite").parquet(f"{folder}/parts")
    return spark.read.parquet(f"{folder}/parts")


def _mapped(store: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A whole file as an array: memory-mapped on a mounted disk, fetched from other stores."""
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)
    with store.open_input_file(path) as file:
        return np.frombuffer(file.read_buffer(), kind)


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _place(folder)
        for batch in batches:
            for row in batch.to_pylist():
                index = _mapped(store, f"{root}/{row['file']}.idx", "<i8").reshape(-1, 3)
                ids = _mapped(store, f"{root}/{row['file']}.ids", f"<u{row['width']}")
                for lo in range(0, len(index) - 1, 4096):
                    own = index[lo : lo + 4097]
                    a, b = own[:-1, 1], own[1:, 1]
                    crcs = [zlib.crc32(ids[x:y].astype("<u4").tobytes()) for x, y in zip(a, b, strict=True)]
                    yield pa.record_batch(
                        [
                            pa.array(own[:-1, 0], pa.int64(), mask=own[:-1, 2] == 0),
                            pa.array(a + row["id_base"], pa.int64()),
                            pa.array(b - a, pa.int64()),
                            pa.array(crcs, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return read


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone.

    ``ids_crc32`` is the unsigned crc32 over the ids as little-endian 32-bit integers.
    """
    parts = spark.read.parquet(f"{folder}/parts")
    dealt = parts.repartition(max(1, spark.sparkContext.defaultParallelism * 4), "part")
    return dealt.mapInArrow(_reader(folder), _FOUND)
