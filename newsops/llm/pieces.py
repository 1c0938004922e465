"""SentencePiece encoding by a table of distinct chunks, and decoding.

The library marks every blank and puts one mark before the text.  Between two
characters that stand side by side in no piece, nothing is ever merged: the mark
after a word is the commonest such place, digits and most punctuation are others.
Texts are cut there, so a chunk is a marked word or a part of one.  The distinct
chunks of the corpus make a table, and their ids go back to their places."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from newsops.llm import runs as R, words as W
from newsops.session import materialise

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: The part of the table that is broadcast: at most so many chunks and bytes of chunks and ids.
TABLE_CHUNKS = 1 << 18
TABLE_BYTES = 1 << 25
SLICE_CHARS = 1 << 18
COUNT_CHARS = 1 << 20
FLUSH_ROWS = 1 << 15
BATCH_BYTES = 1 << 21
TOP_BITS = 20
BLOCK_CHUNKS = 1 << 15


class Pieces:
    """A model and where its texts may be cut; rebuilt from the model's bytes
    wherever it is sent, once a worker."""

    def __init__(self, model: bytes):
        self.model, self.ready = model, False

    def __getstate__(self):
        return {"model": self.model, "ready": False}

    def load(self) -> "Pieces":
        if self.ready:
            return self
        import sentencepiece

        sp = self.sp = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        size = sp.get_piece_size()
        probe = " Ａ ﬁ\té  "
        if sp.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("the model changes texts in other ways than marking blanks")
        if sum(sp.is_byte(i) for i in range(size)) != 256:
            raise ValueError("the model has no byte pieces: runs of unknown characters would be one token")
        pairs = {p[k:k + 2] for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))
                 for p in [sp.id_to_piece(i)] for k in range(len(p) - 1)}
        letters = sorted(set("".join(pairs)))
        if any(p[1] == MARK != p[0] for p in pairs) or "\n" in letters:
            raise ValueError("the model has pieces that go across marks or line breaks")
        self.kind = np.zeros(0x110000, np.int16)
        self.kind[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        joined = np.zeros((len(letters) + 1,) * 2, bool)
        for a, b in pairs:
            joined[self.kind[ord(a)], self.kind[ord(b)]] = True
        self.kinds, self.apart = len(letters) + 1, ~joined.ravel()
        self.before = sp.encode("\n")
        self.ready = True
        return self

    def slices(self, column: pa.Array, chars: int = SLICE_CHARS):
        """The chunks of consecutive rows, some ``chars`` characters at a time; a longer text is a slice."""
        texts, size = [], 0
        for value in column:
            texts.append(value.as_py())
            size += len(texts[-1] or "")
            if size >= chars:
                yield Chunks(self, texts)
                texts, size = [], 0
        if texts:
            yield Chunks(self, texts)

    def segment(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk as 32-bit numbers.  A line break before it, which joins
        with nothing, keeps the library from marking the chunk's own beginning."""
        n = len(self.before)
        return [np.array(ids[n:], np.int32).tobytes() for ids in self.sp.encode(["\n" + c for c in chunks], num_threads=1)]


_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1); those of a usual slice are kept."""
    have = _powers.get(int(base))
    if have is None or n > len(have):
        have = np.full(max(n, COUNT_CHARS), base, np.uint64)
        have[:1] = 1
        have = np.cumprod(have)
        if n <= COUNT_CHARS:
            _powers[int(base)] = have
    return have[:n]


def hashes(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of points start .. end - 1, a Rabin-Karp one from running sums."""
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points + np.uint32(1)) * powers(W.BASE, len(points)), out=sums[1:])
    return W.mix((sums[end] - sums[start]) * powers(W.INVERSE, len(points) + 1)[start])


def alike(one: np.ndarray, a: np.ndarray, other: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which parts one[a : a + size] and other[b : b + size] are equal."""
    skip = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    same = one[np.repeat(a, size) + skip] == other[np.repeat(b, size) + skip]
    wrong = np.zeros(len(size) + 1, np.int64)
    np.add.at(wrong, np.repeat(np.arange(len(size)), size)[~same], 1)
    return wrong[:-1] == 0


class Chunks:
    """Chunks of some rows' marked texts, cut wherever no piece holds both
    neighbours; row r's are bounds[r] to bounds[r + 1]."""

    def __init__(self, pieces: Pieces, texts: list[str | None]):
        marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
        sizes = np.array([len(m) for m in marked], np.int64)
        self.marked = "".join(marked)
        self.points = np.frombuffer(self.marked.encode("utf-32-le"), np.uint32)
        kinds = pieces.kind[self.points].astype(np.int32)
        first = np.concatenate([[0], np.cumsum(sizes)])
        cut = np.ones(len(kinds), bool)
        cut[1:] = pieces.apart[kinds[:-1] * pieces.kinds + kinds[1:]]
        cut[first[:-1][sizes > 0]] = True
        self.start = np.flatnonzero(cut)
        self.end = np.append(self.start[1:], len(kinds)) if len(kinds) else self.start
        self.bounds = np.searchsorted(self.start, first)
        self.hash = hashes(self.points, self.start, self.end)

    def text(self, some: np.ndarray) -> list[str]:
        return list(map(self.marked.__getitem__, map(slice, self.start[some].tolist(), self.end[some].tolist())))

    def counts(self) -> tuple[list[str], np.ndarray]:
        """Distinct chunks and how often each occurs."""
        order = np.argsort(self.hash)
        h, size = self.hash[order], (self.end - self.start)[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        leader = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        fits = size == (self.end - self.start)[leader]
        fits[fits] = alike(self.points, self.start[order[fits]], self.points, self.start[leader[fits]], size[fits])
        # A chunk that only shares the hash of the first is told by itself.
        odd = order[~fits]
        n = np.bincount((np.cumsum(new) - 1)[fits], minlength=int(new.sum()))
        return self.text(np.concatenate([order[new], odd])), np.concatenate([n, np.ones(len(odd), np.int64)])


class Table:
    """Chunks with their ids, packed for the broadcast; arrays once a worker, the
    most frequent chunk first."""

    def __init__(self, blobs: list[bytes]):
        self.blobs, self.ids, self.hash = blobs, None, None

    def __getstate__(self):
        return {"blobs": self.blobs, "ids": None, "hash": None}

    def load(self) -> "Table":
        """The ids: those of chunk c are the id_count[c] from id_start[c] on."""
        if self.ids is None:
            rows = pa.Table.from_batches([b for blob in self.blobs for b in pa.ipc.open_stream(blob)], HEAD)
            self.rows = rows.take(pc.array_sort_indices(pc.negate(rows.column("n").combine_chunks()))).combine_chunks()
            self.id_start, self.id_count, data = flat(self.rows.column("ids"))
            self.ids = np.frombuffer(data, np.int32)
            self.id_start, self.id_count = self.id_start // 4, self.id_count // 4
        return self

    def index(self) -> "Table":
        """Where to look chunks up: by hash."""
        if self.load().hash is None:
            size = pc.utf8_length(self.rows.column("chunk").combine_chunks()).to_numpy().astype(np.int32)
            start = np.cumsum(size, dtype=np.int64) - size
            self.points = np.frombuffer(flat(self.rows.column("chunk"))[2].decode().encode("utf-32-le"), np.uint32)
            h = np.concatenate([hashes(self.points[start[a]:start[b - 1] + size[b - 1]], start[a:b] - start[a], start[a:b] + size[a:b] - start[a])
                                for a in range(0, len(size), BLOCK_CHUNKS) for b in [min(a + BLOCK_CHUNKS, len(size))]] or [np.zeros(0, np.uint64)])
            self.rank = np.argsort(h, kind="stable").astype(np.int32)
            self.hash, self.start, self.size = np.append(h[self.rank], W.NONE), start[self.rank].astype(np.int32), size[self.rank]
            tops = np.arange(1 << TOP_BITS, dtype=np.uint64) << np.uint64(64 - TOP_BITS)
            self.first = np.searchsorted(self.hash, tops).astype(np.int32)
            self.rows = None
        return self

    def find(self, chunks: Chunks) -> np.ndarray:
        """Each chunk's place in the table, -1 where it isn't there."""
        if not len(self.size):
            return np.full(len(chunks.start), -1)
        h = chunks.hash
        at = self.first[(h >> np.uint64(64 - TOP_BITS)).astype(np.int64)].astype(np.int64)
        rest = np.flatnonzero(self.hash[at] < h)
        while len(rest):
            at[rest] += 1
            rest = rest[self.hash[at[rest]] < h[rest]]
        known = (self.hash[at] == h) & (at < len(self.size))
        at[~known] = 0
        known &= self.size[at] == chunks.end - chunks.start
        some = np.flatnonzero(known)
        known[some] = alike(chunks.points, chunks.start[some], self.points, self.start[at[some]], self.size[at[some]])
        return np.where(known, self.rank[at], -1)


HEAD = pa.schema([("chunk", pa.string()), ("n", pa.int64()), ("ids", pa.binary())])


def flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Start and size of each value of a text or binary column, in its bytes."""
    column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    return offsets[:-1] - offsets[0], np.diff(offsets), data.to_pybytes()[offsets[0]:offsets[-1]] if len(column) else b""


def _count(known):
    def scan(batches):
        pieces = known.value.load()
        for batch in batches:
            for part in pieces.slices(batch.column(0), COUNT_CHARS // 2):
                chunks, n = part.counts()
                yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.string()), pa.array(n, pa.int64())], names=["chunk", "n"])
    return scan


def _segment(known):
    def scan(batches):
        pieces = known.value.load()
        for batch in batches:
            ids = pieces.segment(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], names=["chunk", "n", "ids"])
    return scan


def _pack(batches):
    for batch in batches:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, HEAD) as out:
            out.write_batch(pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(batch.columns, HEAD.types)], schema=HEAD))
        yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["blob"])


def _missing(known, table):
    """(doc, rid, chunk, at): chunks of a text that the broadcast part lacks, and their places."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32())]

    def told(out):
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], names=["doc", "rid", "chunk", "at"])

    def scan(batches):
        pieces, have, out = known.value.load(), table.value.index(), []
        for batch in batches:
            doc, rid, row = batch.column(0).to_pylist(), batch.column(1).to_pylist(), 0
            for part in pieces.slices(batch.column(2)):
                lacks = np.flatnonzero(have.find(part) < 0)
                texts, last = part.text(lacks), np.searchsorted(lacks, part.bounds)
                for r in range(len(part.bounds) - 1):
                    places: dict[str, list[int]] = {}
                    for k in range(last[r], last[r + 1]):
                        places.setdefault(texts[k], []).append(int(lacks[k] - part.bounds[r]))
                    out += [(doc[row], rid[row], chunk, at) for chunk, at in places.items()]
                    row += 1
                if len(out) > FLUSH_ROWS:
                    yield told(out)
                    out = []
        yield told(out)
    return scan


def _squeeze(known, table):
    """Each text as the places of its chunks in the table (from 1, 0: not there),
    compressed byte by byte of these numbers: what goes through the shuffle."""
    def scan(batches):
        pieces, have, codec = known.value.load(), table.value.index(), pa.Codec("zstd")
        for batch in batches:
            packed, size = [], []
            for part in pieces.slices(batch.column(3)):
                codes = (have.find(part) + 1).astype("<u4")
                for a, b in zip(part.bounds.tolist(), part.bounds[1:].tolist()):
                    size.append(b - a)
                    packed.append(codec.compress(codes[a:b].view(np.uint8).reshape(-1, 4).T.tobytes(), asbytes=True))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary()), pa.array(size, pa.int64())],
                                             names=["doc_id", "doc", "rid", "packed", "size"])
    return scan


def _found(known, table):
    """Batches (doc_id, text) as (doc_ids, places in the table, bounds) and, of the
    chunks that aren't in the table: where they are, which of ``ids`` each one has, ids."""
    pieces, have = known.value.load(), table.value.index()

    def parts(batch):
        row = 0
        for part in pieces.slices(batch.column(1)):
            codes = have.find(part)
            lacks = np.flatnonzero(codes < 0)
            texts = part.text(lacks)
            new = {text: k for k, text in enumerate(dict.fromkeys(texts))}
            which = np.fromiter(map(new.__getitem__, texts), np.int64, len(texts))
            rows = len(part.bounds) - 1
            yield batch.column(0).slice(row, rows), codes, part.bounds, lacks, which, pieces.segment(list(new))
            row += rows
    return parts


def _joined(batch):
    """Batches (doc_id, packed, size, rest) as the above."""
    codec, first, codes, sizes, more = pa.Codec("zstd"), 0, [], [], []

    def part():
        bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        where = [bounds[r] + np.array(x["at"], np.int64) for r, x in more]
        which = np.repeat(np.arange(len(more)), [len(w) for w in where])
        return batch.column(0).slice(first, len(sizes)), np.concatenate(codes), bounds, np.concatenate([np.zeros(0, np.int64), *where]), which, [x["ids"] for _, x in more]
    for row in range(batch.num_rows):
        n = batch.column(2)[row].as_py()
        raw = codec.decompress(batch.column(1)[row].as_py(), 4 * n, asbytes=True) if n else b""
        more += [(len(sizes), x) for x in batch.column(3)[row].as_py() or ()]
        codes.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, n).T).view("<u4").ravel().astype(np.int64) - 1)
        sizes.append(n)
        if sum(sizes) >= SLICE_CHARS // 4:
            yield part()
            first, codes, sizes, more = row + 1, [], [], []
    if sizes:
        yield part()


def _assemble(known, table, joined: bool):
    """(doc_id, ids): the ids of each text's chunks, in their order."""
    def scan(batches):
        have = table.value.load()
        parts = _joined if joined else _found(known, table)
        for batch in batches:
            for doc_id, at, bounds, where, which, more in parts(batch):
                start, count, seen = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), at >= 0
                start[seen], count[seen] = have.id_start[at[seen]], have.id_count[at[seen]]
                n = np.array([len(x) // 4 for x in more], np.int64)
                start[where], count[where] = (len(have.ids) + np.cumsum(n) - n)[which], n[which]
                ids = np.concatenate([have.ids, np.frombuffer(b"".join(more), np.int32)]) if more else have.ids
                before = np.concatenate([[0], np.cumsum(count)])
                values = ids[np.repeat(start - before[:-1], count) + np.arange(before[-1])]
                yield pa.RecordBatch.from_arrays(
                    [doc_id, pa.ListArray.from_arrays(pa.array(before[bounds], pa.int32()), pa.array(values))], names=["doc_id", "ids"])
    return scan


def counted(docs: DataFrame, known) -> DataFrame:
    """(chunk, n, class): every distinct chunk, how often it occurs, and the class
    of that: four for each doubling, so at most 256."""
    counts = docs.select("text").mapInArrow(_count(known), "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))
    return materialise(counts, "pieces-chunks").withColumn("class", F.floor(4 * F.log2("n")).cast("int"))


def segmented(chunks: DataFrame, known) -> DataFrame:
    """(chunk, n, ids): each chunk with its ids."""
    return chunks.select("chunk", "n").mapInArrow(_segment(known), "chunk string, n long, ids binary")


def encode(docs: DataFrame, model: str = MODEL, table_chunks: int = TABLE_CHUNKS, table_bytes: int = TABLE_BYTES,
           joined: bool = False) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text): the ids that the
    library gives for the whole text, without begin and end.

    All chunks are counted.  The most frequent ones, within ``table_chunks`` and
    ``table_bytes`` (a chunk has at most as many ids as bytes), are segmented once
    and broadcast, and their ids go to each text by place; no text moves.  The
    others are segmented where they stand, once a slice of texts.  With ``joined``
    they too are segmented once in all and joined back by chunk, then by text and
    place; then texts are shuffled, as numbers of chunks.

    Null and empty texts have no ids, an empty table gives no rows, repeated rows
    are kept; other columns of ``docs`` are left out.  The model (its file is read
    by the driver and broadcast) must only mark blanks and have byte pieces.  A
    task holds 256 Ki characters at a time (twice that to count) or one longer
    text, some 60 bytes a character."""
    spark = docs.sparkSession
    with open(model, "rb") as f:
        known = spark.sparkContext.broadcast(Pieces(f.read()))
    chunks = counted(docs, known)
    total, size, least = 0, 0, None
    for c in chunks.groupBy("class").agg(F.count("*").alias("chunks"), F.sum(5 * F.octet_length("chunk")).alias("bytes")).orderBy(F.desc("class")).collect():
        total, size = total + c["chunks"], size + c["bytes"]
        if total > table_chunks or size > table_bytes:
            break
        least = c["class"]
    often = F.lit(False) if least is None else F.col("class") >= least
    table = materialise(segmented(chunks, known), "pieces-table") if joined else None
    first = table.join(chunks.where(often).select("chunk"), "chunk", "left_semi").select("chunk", "n", "ids") if joined else segmented(chunks.where(often), known)
    blobs = first.mapInArrow(_pack, "blob binary").collect()
    head = spark.sparkContext.broadcast(Table([bytes(b[0]) for b in blobs]))
    rows = R.keyed(docs)
    if not joined:
        return rows.select("doc_id", "text").mapInArrow(_assemble(known, head, False), "doc_id long, ids array<int>")
    rest = (rows.select("doc", "rid", "text").mapInArrow(_missing(known, head), "doc long, rid long, chunk string, at array<int>")
            .join(table.select("chunk", "ids"), "chunk")
            .groupBy("doc", "rid").agg(F.collect_set(F.struct("at", "ids")).alias("rest")))
    numbers = rows.select("doc_id", "doc", "rid", "text").mapInArrow(
        _squeeze(known, head), "doc_id long, doc long, rid long, packed binary, size long")
    return numbers.join(rest, ["doc", "rid"], "left").select("doc_id", "packed", "size", "rest").mapInArrow(
        _assemble(known, head, True), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, ids, decoded): the library's text for each row's ids (null or empty: empty)."""
    with open(model, "rb") as f:
        known = encoded.sparkSession.sparkContext.broadcast(Pieces(f.read()))

    def scan(batches):
        sp = known.value.load().sp
        for batch in batches:
            first, texts, size = 0, [], 0
            for row in range(batch.num_rows):
                ids = batch.column(1)[row].as_py()
                texts.append(sp.decode(ids) if ids else "")
                size += len(texts[-1])
                if size > BATCH_BYTES or row + 1 == batch.num_rows:
                    part = batch.slice(first, row + 1 - first)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])
                    first, texts, size = row + 1, [], 0
    return encoded.select("doc_id", "ids").mapInArrow(scan, "doc_id long, ids array<int>, decoded string")


def digest(decoded: DataFrame) -> DataFrame:
    """One narrow row per document: number of ids, hashes of the ids and of the decoded text."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
