"""Order-preserving packing of token streams: windows of at most `size` tokens whose cuts a dynamic program chooses."""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import staged

#: Costs of a cut in tokens of padding: inside a document after a sentence, and inside a sentence.
SENTENCE, WORD = 8, 24
#: Within a sentence every so many tokens is a place for a cut.
STEP = 16
#: A partition is worked on in runs of about so many tokens; what is left of one run begins the next.
RUN = 1 << 18
CACHE = 200_000
#: Controls that only Python counts as white space, and how special tokens begin.
RARE = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")
#: The byte-level vocabularies' sign of each byte: itself where it is printable Latin-1, else the next of those from U+0100 on.
_PLAIN = [b for b in range(256) if 33 <= b <= 126 or b >= 161 and b != 173]
SIGNS = {b: b if b in _PLAIN else 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))} | {b: b for b in _PLAIN}
#: The steps of a tokenizer file before its model that Words repeats word by word.
STEPS = {
    "normalizer": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    "pre_tokenizer": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Known(dict):
    """Ids of words as bytes; a word that is not known yet is encoded by the vocabulary's model, which reads each UTF-8 byte as a printable sign."""

    def __init__(self, model):
        self.model = model

    def __missing__(self, w: str) -> bytes:
        signs = w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(SIGNS)
        self[w] = ids = array("I", [t.id for t in self.model.tokenize(signs)]).tobytes()
        return ids


class Words:
    """Ids of a text from the tokenizer file, word by word with a cache where that provably gives the same ids.

    A tokenizer of these STEPS composes (NFC), lowers case, and splits into runs of letters, single digits and runs of other
    signs, which it encodes one by one. For texts of characters below U+0250 without rare controls and marks these steps
    are the same here, so that each distinct word is encoded once; any other text, and every text of a tokenizer of other
    steps, goes through the tokenizer as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        told = {k: json.loads(getattr(self.tokenizer, k).__getstate__()) if getattr(self.tokenizer, k) is not None else {} for k in STEPS}
        steps = {k: v.get("pretokenizers" if k == "pre_tokenizer" else "normalizers") for k, v in told.items()}
        self.by_word = steps == STEPS and getattr(self.tokenizer.model, "dropout", None) is None
        self.known = Known(self.tokenizer.model)
        kinds = {k: "".join(f"\\u{c:04x}" for c in range(0x250) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
        self.split = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{kinds['L']}]+|[{kinds['N']}]|[^\s{kinds['L']}{kinds['N']}]+").findall
        self.odd = re.compile(r"[^\u0000-\u001b -\u0084\u0086-įı-ɏ]|<\|").search

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit numbers."""
        if len(self.known) > CACHE:
            self.known.clear()
        get, out = self.known.__getitem__, []
        for t in texts:
            if not self.by_word or any(c in t for c in RARE) or not t.isascii() and self.odd(t):
                out.append(np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32))
            else:
                out.append(np.frombuffer(b"".join(map(get, self.split(t.lower()))), np.uint32))
        return out

    def sentence_ends(self) -> np.ndarray:
        """For each id whether it ends a word of closing signs such as '.' or '?"'."""
        out = np.zeros(self.tokenizer.get_vocab_size(), bool)
        out[[i for w, i in self.tokenizer.get_vocab().items() if re.fullmatch(r"[.!?]+[\"')\]]*</w>", w)]] = True
        return out


@lru_cache(1)
def words_of(path: str) -> Words:
    return Words(path)


def cuts(places: np.ndarray, costs: np.ndarray, size: int) -> list[int]:
    """Positions, the last place among them, where windows of at most `size` tokens end at the least sum of padding and cut costs.

    places: allowed positions, ascending, with the cost of a cut at each. With f(j) the least cost of the tokens before j,
    f(j) = cost(j) + size - j + min(f(i) + i) over allowed i from j - size on; a queue of rising f(i) + i gives each
    minimum in constant time.
    """
    queue, back = deque([(0, 0)]), {}
    pop, push, left = queue.pop, queue.append, queue.popleft
    for j, c in zip(places.tolist(), (costs + size).tolist(), strict=True):
        while queue[0][1] < j - size:
            left()
        best, back[j] = queue[0]
        value = best + c  # f(j) + j
        while queue and queue[-1][0] >= value:
            pop()
        push((value, j))
    out = [int(places[-1])]
    while back[out[-1]]:
        out.append(back[out[-1]])
    return out[::-1]


def allowed(ids: np.ndarray, ends: np.ndarray, closing: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a run of tokens may be cut, and at what cost: document ends, sentence ends, and within longer sentences."""
    cost = np.full(len(ids) + 1, WORD, np.int64)
    stop = closing[ids]
    cost[1:][stop] = SENTENCE
    cost[ends] = 0
    at = np.flatnonzero(cost < WORD)
    last = np.zeros(len(ids) + 1, np.int64)
    last[at] = at
    np.maximum.accumulate(last, out=last)
    since = np.arange(len(ids) + 1) - last
    places = np.flatnonzero((cost < WORD) | (since % STEP == 0))
    places = places[places > 0]
    return places, cost[places]


def _pack(batches: Iterator[pa.RecordBatch], path: str, size: int, end_id: int) -> Iterator[pa.RecordBatch]:
    words = words_of(path)
    closing = words.sentence_ends()
    sequence, stream = TaskContext.get().partitionId() << 36, None
    waiting: list[tuple] = []  # (doc_id, start, ids, doc_tokens) not yet in a window
    held = 0

    def emit(stops: list[int]) -> pa.RecordBatch:
        """The tokens before the last stop as pieces; what lies after it waits on."""
        nonlocal sequence, waiting, held
        rows, rest, at, k, offset = [], [], 0, 0, 0
        for doc, start, ids, total in waiting:
            while len(ids) and k < len(stops):
                n = min(len(ids), stops[k] - at)
                rows.append((doc, start, n, ids[:n].tobytes(), total, sequence, offset))
                start, ids, at, offset = start + n, ids[n:], at + n, offset + n
                if at == stops[k]:
                    k, offset, sequence = k + 1, 0, sequence + 1
            if len(ids):
                rest.append((doc, start, ids, total))
        waiting, held = rest, held - at
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], names)

    def plan() -> list[int]:
        ids = np.concatenate([x[2] for x in waiting])
        return cuts(*allowed(ids, np.cumsum([len(x[2]) for x in waiting]), closing), size)

    def finish() -> list[int]:
        """Where to cut all that waits; the last window is short: powers of two take no padding."""
        stops = plan()
        last = stops.pop()
        at = stops[-1] if stops else 0
        while at < last:
            at += 1 << (last - at).bit_length() - 1
            stops.append(at)
        return stops

    for batch in batches:
        docs = batch.column(0).to_pylist()
        streams = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * len(docs)
        for i in range(0, len(docs), 64):
            texts = [t or "" for t in batch.column(1).slice(i, 64).to_pylist()]
            for doc, own, ids in zip(docs[i : i + 64], streams[i : i + 64], words(texts), strict=True):
                if own != stream:
                    if waiting:
                        yield emit(finish())
                    stream, sequence = own, own << 24
                ids = np.append(ids, np.uint32(end_id))
                waiting.append((doc, 0, ids, len(ids)))
                held += len(ids)
            if held >= RUN:
                stops = plan()[:-1]
                if stops:
                    yield emit(stops)
    if waiting:
        yield emit(finish())


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([bkmgtp]?)[a-z]*", size.lower()).groups()
    return int(number) << 10 * "bkmgtp".index(unit or "b")


#: Files of one table that file_streams can number.
MAX_FILES = 1 << 20


def file_streams(docs: DataFrame) -> DataFrame:
    """docs with stream, a number that rises in the order of the names of the files that docs is read from, and of the splits within a file.

    Files of one write have names of one shape, so that shorter names come first and those of one length by their
    letters. One narrow row per file, at most MAX_FILES of them, is ranked and broadcast; no row of docs moves. A stream
    number has 20 bits for the file and 19 for the split's first byte in units of 64 KB, so that splits have to be
    longer than that and files shorter than 32 GB; anything else is an error. Docs that are not read from files
    directly have a null stream: each partition is one.
    """
    try:
        names = docs.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).distinct()
    except AnalysisException:
        return docs.withColumn("stream", F.lit(None).cast("long"))
    names = staged(names, "files")
    n, longest = names.agg(F.count("*"), F.coalesce(F.max("bytes"), F.lit(0))).first()
    conf = docs.sparkSession.conf
    if n > MAX_FILES or longest >= 1 << 35 or min(_bytes(conf.get(f"spark.sql.files.{k}")) for k in ("maxPartitionBytes", "openCostInBytes")) < 1 << 16:
        raise ValueError("too many or too long files, or splits below 64 KB")
    ranks = names.select(F.xxhash64("path").alias("__file"), (F.row_number().over(Window.orderBy(F.length("path"), "path")) - 1).cast("long").alias("__rank"))
    placed = docs.withColumns({"__file": F.xxhash64("_metadata.file_path"), "__at": F.shiftright("_metadata.file_block_start", 16)})
    stream = F.shiftleft("__rank", 19) + F.col("__at")
    return placed.join(F.broadcast(ranks), "__file").withColumn("stream", stream).drop("__file", "__at", "__rank")


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 1, stream: str | None = None) -> DataFrame:
    """The token ids of each row's text, followed by end_id, as pieces of sequences of at most `size` tokens.

    One row per piece: doc_id, start (ids of its document before it), length, ids (little-endian unsigned 32-bit
    numbers), doc_tokens (ids of the document, end_id included), sequence_id, offset (place in its sequence).
    Each partition of docs is a stream in its own order, so that the order of a sorted table is kept and no row moves.
    With `stream`, a column of numbers (see file_streams), a run of rows of one number is a stream, whose sequences come
    after those of smaller numbers wherever it is read.
    A sequence that is not full is padded to `size`, unless its length is a power of two; the last window of a
    partition is split into such lengths.

    A null or empty text is the piece [end_id]. Repeated rows, ties and rows without doc_id are packed each. Texts of
    any length are cut as needed. Columns other than doc_id and text are not read. An empty table gives an empty result.
    `tokenizer` is a path that every executor can read.
    """
    own = [f"`{stream}` stream"] if stream else []
    return docs.selectExpr("cast(doc_id as long) doc_id", "text", *own).mapInArrow(lambda it: _pack(it, tokenizer, size, end_id), SCHEMA)
