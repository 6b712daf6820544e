"""Token ids as flat binary files.

A part is three files: `.ids` (unsigned little-endian integers, 16 bits if the vocabulary allows it,
else 32), `.off` (n + 1 unsigned 64-bit offsets, in ids, of the part's documents) and `.doc` (64-bit
document ids). Parts follow each other in ascending order of document id; a manifest table holds their
paths, sizes and the base of each part, a prefix sum over the sizes. Files are named by task attempt,
and only files of the attempts that Spark took are in the manifest.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomtext import session
from loomtext.llm.common import attempt, batches, doc_bytes, filesystem, stored, tidy

#: Documents that one reading task takes at most.
READ_DOCS = 10_000
MAX_READERS = 10_000

# How the word vocabulary cuts a normalised text, here for ASCII and Latin letters.
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ɏ]+|[0-9]|[!-/:-@\[-`{-~]+")
PLAIN = re.compile(r"[!-~ßà-öø-ÿ]+\Z")
LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
AFTER = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"  # no apostrophe, which may begin a piece with letters, and no mark of special tokens
SIMPLE = r"^[A-Za-zÀ-ÖØ-öø-ÿ]+[!-&(-/:;=-@\[-`{-~]*$"


class Remembered(dict):
    """Short word -> what `make` gives for it, for a bounded number of words.

    When it is full, its words become the old ones and are forgotten unless they are met again, so
    frequent words stay.
    """

    def __init__(self, make: Callable[[bytes], bytes], limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, word: bytes) -> bytes:
        got = self.old.get(word)
        if got is None:
            got = self.make(word)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.old = self.copy()
                self.clear()
            self[word] = got
        return got


class Encoder:
    """Encodes batches of texts with a `tokenizers` model.

    A vocabulary that cuts at white space encodes every word by itself, so the ids of a text are those of
    its words in turn: a batch is cut into words, each different word is encoded once, and the ids are
    gathered. A word of Latin letters and punctuation after them (`SIMPLE`) is two pieces, and pieces are remembered
    from batch to batch. Any other word, and any with a special token in it, goes through the whole
    tokenizer or its pieces. `by_word` is found by the vocabulary's own settings; other vocabularies encode
    whole texts.
    """

    WORDS = 120_000
    BLOCK = 2_000_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.dtype = id_type(self.tok)
        self.code = "H" if self.dtype == "<u2" else "I"
        self.by_word = cuts_at_white_space(self.tok)
        self.words = Remembered(self.word, self.WORDS)
        self.pieces = Remembered(self.piece, self.WORDS)
        self.marks = [t.content.lower() for t in self.tok.get_added_tokens_decoder().values()]
        self.simple = all("<" in m for m in self.marks)
        self.byte_char = dict(enumerate(byte_chars()))

    def ids(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def piece(self, p: bytes) -> bytes:
        """Ids of lower-case letters, of punctuation or of one digit."""
        text = p.decode("latin-1")
        return self.ids([t.id for t in self.tok.model.tokenize(text if p.isalpha() else text.translate(self.byte_char))])

    def word(self, w: bytes) -> bytes:
        text = w.decode("utf-8", "replace")
        low = text.lower()
        if len(w) <= 1000 and PLAIN.match(low) and not any(m in low for m in self.marks):
            return b"".join([self.pieces[p.encode()] for p in PIECE.findall(low)])
        return self.ids(self.tok.encode(text, add_special_tokens=False).ids)

    def __call__(self, data: bytes) -> bytes:
        """Ids of one text."""
        if not self.by_word:
            return self.ids(self.tok.encode(data.decode("utf-8", "replace"), add_special_tokens=False).ids)
        return b"".join(map(self.words.__getitem__, data.split()))

    def texts(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, ids of each text) of a column of UTF-8 bytes, in blocks of about BLOCK bytes or one text."""
        ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(column):
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + self.BLOCK, "right")))
            part = column.slice(at, stop - at)
            yield self.block(part) if self.by_word else self.whole(part)
            at = stop

    def whole(self, part: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [np.frombuffer(self(t.as_py()), self.dtype) for t in part]
        return np.concatenate(found), np.array([len(x) for x in found], np.int64)

    def block(self, part: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        try:
            cut = pc.ascii_split_whitespace(part.cast(pa.large_string()))
        except pa.ArrowInvalid:  # bytes that are no text
            return self.whole(part)
        words = cut.flatten()
        solid = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(part)), np.diff(cut.offsets.to_numpy()))[solid]
        words = words.filter(pa.array(solid)).dictionary_encode()
        flat, starts, sizes = self.distinct(words.dictionary)
        index = words.indices.to_numpy()
        n = sizes[index]
        counts = np.bincount(owner, n, len(part)).astype(np.int64)
        return gathered(flat, starts[index], n), counts

    def distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids of different words, and where those of each word start and how many there are."""
        n = len(words)
        simple = pc.match_substring_regex(words, SIMPLE).to_numpy(zero_copy_only=False) if self.simple else np.zeros(n, bool)
        simple &= pc.binary_length(words).to_numpy(zero_copy_only=False) <= 1000
        low = pc.utf8_lower(words.filter(pa.array(simple)))
        stems = pc.utf8_rtrim(low, characters=AFTER).dictionary_encode()
        tails = pc.utf8_ltrim(low, characters=LETTERS).dictionary_encode()
        found = [self.pieces[p] if p else b"" for p in stems.dictionary.cast(pa.large_binary()).to_pylist()]
        after = [self.pieces[p] if p else b"" for p in tails.dictionary.cast(pa.large_binary()).to_pylist()]
        other = [self.words[w] for w in words.filter(pa.array(~simple)).cast(pa.large_binary()).to_pylist()]
        table = found + after + other
        flat = np.frombuffer(b"".join(table), self.dtype)
        size = np.array([len(x) for x in table], np.int64) // np.dtype(self.dtype).itemsize
        start = np.cumsum(size) - size
        # the pieces of each word: a stem and what follows it, or the whole word and nothing
        first, second = np.empty(n, np.int64), np.empty(n, np.int64)
        first[simple], second[simple] = stems.indices.to_numpy(), tails.indices.to_numpy() + len(found)
        first[~simple] = len(found) + len(after) + np.arange(len(other))
        both = np.stack([first, np.where(simple, second, 0)], axis=1)
        sizes = np.stack([size[first], np.where(simple, size[both[:, 1]], 0)], axis=1)
        out = gathered(flat, start[both].ravel(), sizes.ravel())
        total = sizes.sum(axis=1)
        return out, np.cumsum(total) - total, total


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of `flat` that start at `starts`, one after another."""
    ends = np.cumsum(sizes)
    return flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]


def id_type(tok) -> str:
    return "<u2" if tok.get_vocab_size() <= 1 << 16 else "<u4"


def cuts_at_white_space(tok) -> bool:
    """True for the kind of vocabulary whose settings make words independent: lower case, white space dropped."""
    import json

    conf = json.loads(tok.to_str())
    norm = (conf.get("normalizer") or {}).get("normalizers") or []
    pre = (conf.get("pre_tokenizer") or {}).get("pretokenizers") or []
    return (
        [n["type"] for n in norm] == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in pre] == ["Split", "ByteLevel"]
        and pre[0].get("behavior") == "Removed" and pre[0].get("invert") is True
        and pre[0]["pattern"].get("Regex") == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        and not pre[1].get("add_prefix_space") and not pre[1].get("use_regex")
    )


def byte_chars() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if printable, else 256 upward."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in shown)}
    return [chr(rest.get(b, b)) for b in range(256)]


def encoder(path: str) -> Encoder:
    """A new one for each task: a worker process that is used again keeps neither the model nor the words."""
    return Encoder(path)


MANIFEST = pa.schema([
    ("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_null", pa.int64()), ("n_tokens", pa.int64()),
])
MANIFEST_DDL = "part int, path string, n_docs long, n_null long, n_tokens long"
ROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
ROW_DDL = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """Write the files below `folder`; returns the manifest with each part's `base`, as a stored table.

    A null text is empty: its document holds the end id alone. Null document ids come first. Equal
    ids follow the hash of their texts; rows equal in both cannot be told apart. Other columns are
    not read. A table without rows gives a manifest without rows. A range of ids that is one id alone
    is still dealt over several parts.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), doc_bytes(F.col(text)).alias("data"))
    rows = rows.withColumn("tie", F.xxhash64("data")).withColumn("row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange("id", "tie", "row").sortWithinPartitions("id", "tie").select("id", "data")

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, n_null, n_tokens, lengths, ids = encoder(tokenizer), 0, 0, [], []
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        name = f"part-{attempt()}"
        out = None
        for batch in it:
            if out is None:
                out = fs.open_output_stream(f"{root}/{name}.ids", compression=None)
            n_null += batch.column(0).null_count
            ids.append(batch.column(0).fill_null(0).to_numpy())
            for flat, counts in enc.texts(batch.column(1)):
                out.write(np.insert(flat, np.cumsum(counts), end_id).tobytes())
                lengths.append(counts + 1)
        if out is None:
            return
        out.close()
        lengths = np.concatenate([np.zeros(1, np.int64), *lengths])
        offsets = np.cumsum(lengths).astype("<u8")
        for kind, values in (("off", offsets), ("doc", np.concatenate(ids).astype("<i8"))):
            with fs.open_output_stream(f"{root}/{name}.{kind}", compression=None) as f:
                f.write(values.tobytes())
        yield from batches([{
            "part": TaskContext.get().partitionId(), "path": f"{folder}/{name}", "n_docs": len(lengths) - 1,
            "n_null": n_null, "n_tokens": int(offsets[-1]),
        }], MANIFEST)

    with session.text_batches(docs.sparkSession):
        manifest = stored(rows.mapInArrow(lambda it: tidy(write(it)), MANIFEST_DDL), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part, not per document
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def load(path: str, dtype: str, first: int, count: int) -> np.ndarray:
    """A range of a flat file: memory-mapped if the file system is local, else read by range."""
    if not count:
        return np.zeros(0, dtype)
    fs, p = filesystem(path)
    if fs.type_name == "local":
        return np.memmap(p, dtype, "r")[first : first + count]
    size = np.dtype(dtype).itemsize
    with fs.open_input_file(p) as f:
        return np.frombuffer(f.read_at(count * size, first * size), dtype)


def read_token_files(spark: SparkSession, manifest: DataFrame, dtype: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the files alone."""
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_docs") - 1, F.lit(READ_DOCS).cast("long")))
    pieces = manifest.select("path", "base", "n_docs", "n_null", first.alias("first"))
    pieces = pieces.repartition(min(MAX_READERS, max(1, pieces.count())), "path", "first")  # a few bytes each: never merged

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for p in batch.to_pylist():
                n = min(READ_DOCS, p["n_docs"] - p["first"])
                off = load(p["path"] + ".off", "<u8", p["first"], n + 1).astype(np.int64)
                doc = load(p["path"] + ".doc", "<i8", p["first"], n).tolist()
                ids = load(p["path"] + ".ids", dtype, int(off[0]), int(off[-1] - off[0]))
                rows = []
                for i in range(n):
                    own = ids[off[i] - off[0] : off[i + 1] - off[0]]
                    rows.append({
                        "doc_id": None if p["first"] + i < p["n_null"] else doc[i], "start": p["base"] + int(off[i]),
                        "n_tokens": len(own), "ids_crc32": zlib.crc32(own.astype("<u4").tobytes()),
                    })
                yield from batches(rows, ROW)

    return pieces.mapInArrow(read, ROW_DDL)
