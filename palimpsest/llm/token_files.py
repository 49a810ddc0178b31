"""Token ids in Arrow files of fixed-size lists.

Documents are dealt by ranges of doc_id, or of an order that is given, and sorted; each task encodes its range and writes two
files in the Arrow file format (the stream format with a footer, so any batch is found without
reading the others):

- ``*.tokens.arrow``: ``tokens`` fixed_size_list<uint16 or uint32>[length], as the vocabulary needs, and ``mask``
  fixed_size_list<bool>[length], batches of ``batch`` sequences. The stream of ids runs on from one sequence to the
  next; only a file's last sequence is padded, with mask false. Memory-mapped, any sequence or id is reached without a copy.
- ``*.docs.arrow``: ``doc_id, start, n_tokens`` of each document in the file's stream.

A task that runs again writes files of another name; the manifest lists those of the task that counted.

Defined results: a null or empty text has the end id alone; a null doc_id comes first; rows with equal ids are
ordered by text; an empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.llm.common import new_dir, own_columns, spans, strings, table, written

LENGTH, BATCH = 2048, 128
END_ID = 2
#: Words that a worker remembers ids of at least and, twice over, at most; characters of such a word, and bytes of texts encoded together.
WORDS, SHORT, BLOCK = 150_000, 64, 4_000_000
#: Characters of a text that deal rows of equal ids.
HEAD = 16
# What the word tokenizer does before its merges, and the end of a word in its vocabulary.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
WORD_END = "</w>"
#: Words of Latin letters: such a word is one piece, and lower case changes its letters one by one. U+0130 would become two characters.
LETTERS = "^[A-Za-zªµºÀ-ÖØ-öø-\u012f\u0131-\u024f]+$"
_GAP = re.compile(r"[\x20\x09-\x0D]")
_APART = re.compile(f"[{re.escape(punctuation)}][A-Za-z]")


def gathered(flat: np.ndarray, start: np.ndarray, size: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` that ``index`` numbers, one after another, and the size of each."""
    n = size[index]
    ends = np.cumsum(n)
    at = np.arange(ends[-1] if len(ends) else 0)
    at += np.repeat(start[index] - (ends - n), n)
    return flat[at], n


class Encoder:
    """Ids of whole texts by the tokenizers library, as an array of an unsigned type.

    A tokenizer that is known to cut at white space, and between a Latin letter and ASCII punctuation behind it, encodes each word
    once per block of texts; frequent words are remembered. What is cut is a word of Latin letters, in lower case, with its
    punctuation apart; any other word between blanks is encoded as it stands. Any other tokenizer gets whole texts.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        told = json.loads(self.tokenizer.to_str())
        # A special token must not fit into letters with punctuation behind them, nor hold a blank.
        plain = all(not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or _GAP.search(t["content"])) and _APART.search(t["content"]) for t in told["added_tokens"])
        self.by_word = plain and not told["truncation"] and not told["padding"] and told["normalizer"] == NORMALIZER and told["pre_tokenizer"] == PRE_TOKENIZER and told["model"].get("end_of_word_suffix") == WORD_END
        # Tokens that end a word.
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(WORD_END)]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _each(self, texts: list[str]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), 1024):
            got = self.tokenizer.encode_batch_fast(texts[at : at + 1024], add_special_tokens=False)
            out += [np.array(x.ids, self.type).tobytes() for x in got]
        return out

    def _letters(self, words: list[str]) -> list[bytes]:
        """Words of letters go through in one text and are told apart by the ends of words."""
        out = []
        for at in range(0, len(words), 1024):
            some = words[at : at + 1024]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.type)
            ends = ((np.flatnonzero(self.ends[ids]) + 1) * self.type.itemsize).tolist()
            raw = ids.tobytes()
            out += [raw[i:j] for i, j in zip([0, *ends], ends, strict=False)] if len(ends) == len(some) else self._each(some)
        return out

    def _remembered(self, words: list[str], encode: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        if len(self.young) > WORDS:
            self.old, self.young = self.young, {}
        got = list(map(self.young.get, words))
        missing = [i for i, x in enumerate(got) if x is None]
        fresh = []
        for i in missing:
            if (x := self.old.get(words[i])) is None:
                fresh.append(i)
            else:
                got[i] = self.young[words[i]] = x
        for i, x in zip(fresh, encode([words[i] for i in fresh]), strict=True):
            got[i] = x
            if len(words[i]) <= SHORT:
                self.young[words[i]] = x
        return got

    def _runs(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all the words, and where those of each start and how many they are."""
        core = pc.ascii_rtrim(words, characters=punctuation)
        simple = pc.match_substring_regex(core, LETTERS)
        mask = simple.to_numpy(zero_copy_only=False)
        core = core.filter(simple)
        letters = pc.utf8_lower(core).dictionary_encode()
        tails = [w[n:] for w, n in zip(strings(words.filter(simple)), pc.utf8_length(core).to_numpy().tolist(), strict=True)]
        number = {t: i for i, t in enumerate(dict.fromkeys(["", *tails]))}
        units = self._remembered(strings(letters.dictionary), self._letters)
        first_tail, first_other = len(units), len(units) + len(number)
        units += self._remembered(list(number), self._each)
        units += self._remembered(strings(words.filter(pc.invert(simple))), self._each)
        unit = np.full((len(words), 2), first_tail)
        unit[mask, 0] = letters.indices.to_numpy()
        unit[mask, 1] += np.fromiter(map(number.__getitem__, tails), np.int64, len(tails))
        unit[~mask, 0] = np.arange(first_other, len(units))
        size = np.fromiter(map(len, units), np.int64, len(units)) // self.type.itemsize
        flat, n = gathered(np.frombuffer(b"".join(units), self.type), np.cumsum(size) - size, size, unit.ravel())
        size = n.reshape(-1, 2).sum(1)
        return flat, np.cumsum(size) - size, size

    def _block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without nulls, one after another, and how many each has."""
        if not self.by_word:
            got = self._each(strings(texts))
            return np.frombuffer(b"".join(got), self.type), np.array([len(x) for x in got], np.int64) // self.type.itemsize
        words = pc.ascii_split_whitespace(texts)
        coded = words.values.dictionary_encode()
        ids, n = gathered(*self._runs(coded.dictionary), coded.indices.to_numpy())
        return ids, np.diff(np.r_[0, np.cumsum(n)][words.offsets.to_numpy()])

    def ids(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of some texts after others: their ids one after another, and how many each has; a null text has none.

        A text above ``BLOCK`` is cut at white space where the tokenizer cuts there, so what is in hand at once has a bound.
        """
        texts = texts.fill_null("")
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        for at, end in spans(size, BLOCK):
            if size[at] <= BLOCK or not self.by_word:
                yield self._block(texts.slice(at, end - at))
                continue
            text, start, got = texts[at].as_py(), 0, []
            while start < len(text):
                gap = _GAP.search(text, start + BLOCK // 4)
                stop = gap.start() if gap else len(text)
                got.append(self._block(pa.array([text[start:stop]]))[0])
                start = stop
            ids = np.concatenate(got)
            yield ids, np.array([len(ids)])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class TokenWriter:
    """One pair of files; ids are added document by document."""

    def __init__(self, fs: pafs.FileSystem, stem: str, id_type: pa.DataType, type_: np.dtype, length: int, batch: int) -> None:
        self.length, self.room, self.type = length, length * batch, type_
        self.sinks = [fs.open_output_stream(f"{stem}.tokens.arrow"), fs.open_output_stream(f"{stem}.docs.arrow")]
        self.schema = pa.schema([("tokens", pa.list_(pa.from_numpy_dtype(type_), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.index = pa.schema([("doc_id", id_type), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.out = pa.ipc.new_file(self.sinks[0], self.schema)
        self.docs = pa.ipc.new_file(self.sinks[1], self.index)
        self.held: list[np.ndarray] = []
        self.waiting = self.total = 0

    def _write(self, ids: np.ndarray) -> None:
        pad = -len(ids) % self.length
        mask = np.r_[np.ones(len(ids), bool), np.zeros(pad, bool)]
        ids = np.r_[ids, np.zeros(pad, self.type)] if pad else ids
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
        self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def add(self, doc_ids: pa.Array, ids: np.ndarray, n: np.ndarray) -> None:
        """Documents, their ids one after another, and how many each has."""
        self.docs.write_batch(pa.RecordBatch.from_arrays([doc_ids, pa.array(self.total + np.cumsum(n) - n), pa.array(n)], schema=self.index))
        self.held.append(ids)
        self.total += len(ids)
        self.waiting += len(ids)
        if self.waiting >= self.room:
            ids = np.concatenate(self.held)
            whole = len(ids) - len(ids) % self.room
            for at in range(0, whole, self.room):
                self._write(ids[at : at + self.room])
            self.held, self.waiting = [ids[whole:].copy()], len(ids) - whole

    def close(self) -> int:
        if self.waiting:
            self._write(np.concatenate(self.held))
        for x in (self.out, self.docs, *self.sinks):
            x.close()
        return self.total


class TokenFile:
    """Random access to a token file; local files are mapped, so arrays are views of the file."""

    def __init__(self, uri: str) -> None:
        fs, path = pafs.FileSystem.from_uri(uri)
        source = pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path)
        self.file = pa.ipc.open_file(source)
        self.length = self.file.schema.field("tokens").type.list_size
        self.batch = self.file.get_batch(0).num_rows if self.file.num_record_batches else 1
        self._at, self._got = -1, None

    def _lists(self, batch: int) -> pa.RecordBatch:
        if self._at != batch:
            self._at, self._got = batch, self.file.get_batch(batch)
        return self._got

    def _values(self, batch: int) -> np.ndarray:
        return self._lists(batch).column("tokens").values.to_numpy(zero_copy_only=True)

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of the i-th sequence."""
        at = i % self.batch * self.length
        mask = self._lists(i // self.batch).column("mask").values.slice(at, self.length)
        return self._values(i // self.batch)[at : at + self.length], mask

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids ``start`` to ``start + n`` of the file's stream; a copy only where they cross batches."""
        room, parts = self.length * self.batch, []
        while n > 0:
            part = self._values(start // room)[start % room : start % room + n]
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.zeros(0, np.uint16)])


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int | None = END_ID, length: int = LENGTH, batch: int = BATCH, order: Sequence[str] = ()) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files in ``folder``; returns the manifest ``part, tokens, docs, n_tokens, start``.

    ``part`` numbers the files in ascending order of doc_id, or of the columns ``order``; ``start`` counts the ids of all files before.
    """
    rows = own_columns(docs, "doc_id", "text", *order)
    if order:
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order, "doc_id", "text").select("doc_id", "text")
    else:
        # Bounds of ranges hold the beginnings of texts alone; these have the order of the texts.
        rows = rows.repartitionByRange("doc_id", F.substring("text", 1, HEAD)).sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        task, writer, stem = TaskContext.get(), None, ""
        enc = encoder(tokenizer)
        for b in batches:
            if not b.num_rows:
                continue
            if writer is None:
                fs.create_dir(root, recursive=True)
                stem = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
                writer = TokenWriter(fs, f"{root}/{stem}", b.column("doc_id").type, enc.type, length, batch)
            at = 0
            for ids, n in enc.ids(b.column("text")):
                if end_id is not None:
                    ids, n = np.insert(ids, np.cumsum(n), end_id), n + 1
                writer.add(b.column("doc_id").slice(at, len(n)), ids, n)
                at += len(n)
        if writer is not None:
            yield pa.RecordBatch.from_pylist([{"part": task.partitionId(), "tokens": f"{folder}/{stem}.tokens.arrow", "docs": f"{folder}/{stem}.docs.arrow", "n_tokens": writer.close()}])

    files = written(rows.mapInArrow(run, "part long, tokens string, docs string, n_tokens long"), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, id_type: str = "long") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files of ``manifest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                tokens = TokenFile(row["tokens"])
                fs, path = pafs.FileSystem.from_uri(row["docs"])
                index = pa.ipc.open_file(fs.open_input_file(path))
                for i in range(index.num_record_batches):
                    part = index.get_batch(i)
                    start, n = part.column("start").to_numpy(), part.column("n_tokens").to_numpy()
                    crc = [zlib.crc32(tokens.ids(s, k).astype("<u4").tobytes()) for s, k in zip(start.tolist(), n.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(start + row["start"]), part.column("n_tokens"), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    files = max(1, manifest.count())
    return manifest.repartition(files).mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def in_order(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with ``__part`` and ``__row``, which number the rows in the order that they have or were written in.

    Spark reads files in an order of its own, but their names count the parts of the table that was written.
    """
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.child()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return own_columns(docs, "doc_id", "text").select("*", F.lit(0).cast("long").alias("__part"), F.monotonically_increasing_id().alias("__row"))
    part, file = (F.coalesce(F.expr(f"try_cast(regexp_extract(_metadata.file_name, '{p}', 1) as long)"), F.lit(0).cast("long")) for p in (r"^part-([0-9]+)", r"-c([0-9]+)[.]"))
    # A task's files and their rows; 40 bits are left for the rows of a file.
    return docs.select("doc_id", "text", part.alias("__part"), (F.shiftleft(file, 40) + F.col("_metadata.row_index")).alias("__row"))


def token_digests(docs: DataFrame, ordered: bool = False) -> DataFrame:
    """Write all documents to files in the shared folder and read them back; ``ordered``: in the order of ``docs`` instead of doc_id's."""
    folder = new_dir(docs.sparkSession, "tokens")
    rows, order = (in_order(docs), ["__part", "__row"]) if ordered else (docs, [])
    manifest = write_token_files(rows, default_tokenizer(), folder, order=order)
    return read_token_files(manifest, docs.schema["doc_id"].dataType.simpleString())


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))
