"""Alignment of two tokenizers' tokens over the same bytes, by merge paths.

Both token lists are sorted lists of end offsets.  Merging them visits every
stretch of bytes between two neighbouring ends; such a stretch lies in one token
of each side, which makes one link.  Where a diagonal of the merge is crossed
follows from a binary search alone, so the merge of a whole slice of texts falls
into pieces of equal work, whatever the texts' lengths, and each piece emits its
links by itself.  Groups end where both sides end; those that go on across a
piece's border are stitched by counting the ends before it."""
from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsops.session import materialise

A_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
B_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# Fixed value: how the byte-level vocabulary cuts text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longer texts take the slower encoder: the fast one's pattern fails on a million blanks.
FAST_CHARS = 100_000
SLICE_CHARS = 1 << 18
PIECE_STEPS = 1 << 15
#: Pairs whose counts are broadcast, 17 bytes each.
TABLE_PAIRS = 1 << 20


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: its own
    where that is printable, otherwise the next one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Tokenizers:
    """Both tokenizers and the bytes of their tokens; rebuilt once a worker."""

    def __init__(self, a: str, b: bytes):
        self.files, self.ready = (a, b), False

    def __getstate__(self):
        return {"files": self.files, "ready": False}

    def load(self) -> "Tokenizers":
        if self.ready:
            return self
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(self.files[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=self.files[1])
        parts, letters = json.loads(self.files[0]), byte_letters()
        special = {t["id"] for t in parts["added_tokens"]}
        ids = {bytes(letters[c] for c in t): i for t, i in parts["model"]["vocab"].items() if i not in special}
        merged = [bytes(letters[c] for c in "".join(m if isinstance(m, list) else m.split(" "))) for m in parts["model"]["merges"]]
        if [ids.get(m) for m in merged] != list(range(256, 256 + len(merged))):
            raise ValueError("side A needs a byte-level vocabulary whose ids are in the order of its merges")
        self.fast = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ids, special_tokens={})
        self.a_bytes = [b""] * (max([*ids.values(), *special]) + 1)
        for t, i in ids.items():
            self.a_bytes[i] = t
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
                        for i in range(self.b.get_piece_size()) for p in [self.b.id_to_piece(i)]]
        self.a_sizes = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        # Each id as it stands within a group and at the end of its side of a group.
        self.a_told, self.b_told = (np.array([f"{i}{end}" for end in ("," + last) for i in range(n)], object)
                                    for n, last in ((len(self.a_bytes), "|"), (len(self.b_bytes), ";")))
        self.ready = True
        return self

    def encode_a(self, text: str) -> np.ndarray:
        if len(text) > FAST_CHARS:
            return np.array(self.a.encode(text, add_special_tokens=False).ids, np.int64)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.int64)

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text on both sides; none where a text is null or empty, or
        the tokens' bytes aren't those of a blank and the text."""
        some = [t or "" for t in texts]
        none, left, right = np.zeros(0, np.int64), [], []
        for text, b in zip(some, self.b.encode(some, num_threads=1)):
            a, want = self.encode_a(" " + text), (" " + text).encode()
            fits = (text and b"".join(map(self.a_bytes.__getitem__, a.tolist())) == want
                    and b"".join(map(self.b_bytes.__getitem__, b)) == want)
            left.append(a if fits else none)
            right.append(np.array(b, np.int64) if fits else none)
        return left, right


def crossings(a_end: np.ndarray, b_end: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of either side the merge has taken after 0, ``steps``, 2 *
    ``steps`` ... steps and at its end; of equal ends that of A comes first."""
    n = len(a_end) + len(b_end)
    d = np.append(np.arange(0, n, steps), n)
    lo, hi = np.maximum(0, d - len(b_end)), np.minimum(d, len(a_end))
    while (lo < hi).any():
        open_ = np.flatnonzero(lo < hi)
        mid = (lo + hi)[open_] >> 1
        taken = a_end[mid] <= b_end[d[open_] - mid - 1]
        lo[open_[taken]] = mid[taken] + 1
        hi[open_[~taken]] = mid[~taken]
    return lo, d - lo


def piece(a_end: np.ndarray, b_end: np.ndarray, i0: int, i1: int, j0: int, j1: int):
    """Links (token of A, token of B) and ends of groups (tokens of A and of B so
    far) that the steps between two crossings emit."""
    a, b = a_end[i0:i1], b_end[j0:j1]
    end, from_a = np.empty(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), bool)
    at = np.arange(len(a)) + np.searchsorted(b, a, "left")
    from_a[at] = True
    end[at], end[~from_a] = a, b
    before = np.empty_like(end)
    before[1:] = end[:-1]
    before[:1] = max(int(a_end[i0 - 1]) if i0 else 0, int(b_end[j0 - 1]) if j0 else 0)
    i = i0 + np.cumsum(from_a) - from_a
    j = j0 + np.cumsum(~from_a) - ~from_a
    new = end > before
    return i[new], j[new], i[~new], j[~new] + 1


def merge(a_end: np.ndarray, b_end: np.ndarray, steps: int = PIECE_STEPS):
    """Links and ends of groups of two lists of ends, piece by piece."""
    i, j = crossings(a_end, b_end, steps)
    parts = [piece(a_end, b_end, *x) for x in zip(i[:-1].tolist(), i[1:].tolist(), j[:-1].tolist(), j[1:].tolist())]
    return tuple(np.concatenate(x) if parts else np.zeros(0, np.int64) for x in (zip(*parts) if parts else [()] * 4))


def _lists(values: pa.Array, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)


def _slices(column: pa.Array):
    first, texts, size = 0, [], 0
    for row, value in enumerate(column):
        texts.append(value.as_py())
        size += len(texts[-1] or "")
        if size >= SLICE_CHARS:
            yield first, texts
            first, texts, size = row + 1, [], 0
    if texts:
        yield first, texts


def _told(both: Tokenizers, a, b, a_to, b_to, a_bounds, b_bounds) -> list[str]:
    """Each document's groups in the form a1,a2|b1;a3|b2,b3."""
    a_from, b_from = np.concatenate([[0], a_to])[:-1], np.concatenate([[0], b_to])[:-1]
    told = np.empty(len(a) + len(b), object)
    last = np.zeros(len(a), np.int64)
    last[a_to - 1] = len(both.a_bytes)
    told[np.arange(len(a)) + np.repeat(b_from, a_to - a_from)] = both.a_told[a + last]
    last = np.zeros(len(b), np.int64)
    last[b_to - 1] = len(both.b_bytes)
    told[np.arange(len(b)) + np.repeat(a_to, b_to - b_from)] = both.b_told[b + last]
    told, bounds = told.tolist(), (a_bounds + b_bounds).tolist()
    return ["".join(told[x:y])[:-1] for x, y in zip(bounds, bounds[1:])]


def _align(known, steps: int, notation: bool):
    def scan(batches):
        both = known.value.load()
        kinds = len(both.a_bytes) * len(both.b_bytes)
        for batch in batches:
            for first, texts in _slices(batch.column(1)):
                left, right = both.encode(texts)
                n_a, n_b = np.array([len(x) for x in left]), np.array([len(x) for x in right])
                a_bounds, b_bounds = np.concatenate([[0], np.cumsum(n_a)]), np.concatenate([[0], np.cumsum(n_b)])
                a, b = np.concatenate(left), np.concatenate(right)
                i, j, a_to, b_to = merge(np.cumsum(both.a_sizes[a]), np.cumsum(both.b_sizes[b]), steps)
                of, link_of = np.searchsorted(a_to, a_bounds, "right"), np.searchsorted(i, a_bounds)
                if notation:
                    groups = pa.array(_told(both, a, b, a_to, b_to, a_bounds, b_bounds), pa.string())
                else:
                    groups = _lists(pa.StructArray.from_arrays([
                        _lists(pa.array(x, pa.int32()), np.concatenate([[0], to])) for x, to in ((a, a_to), (b, b_to))], names=["a", "b"]), of)
                links = np.repeat(np.arange(len(texts)), np.diff(link_of)) * kinds + a[i] * len(both.b_bytes) + b[j]
                pairs, n = np.unique(links, return_counts=True)
                at = pairs % kinds
                pairs_of = pa.StructArray.from_arrays([pa.array(x, pa.int32()) for x in (at // len(both.b_bytes), at % len(both.b_bytes), n)],
                                                      names=["a", "b", "n"])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(texts)), *(pa.array(x, pa.int64()) for x in (n_a, n_b, np.diff(of), np.diff(link_of))),
                    groups, _lists(pairs_of, np.searchsorted(pairs, np.arange(len(texts) + 1) * kinds))],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs"])
    return scan


def align(docs: DataFrame, a_model: str = A_MODEL, b_model: str = B_MODEL, steps: int = PIECE_STEPS,
          notation: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, pairs) of every row of ``docs``
    (doc_id, text).

    Side A is a byte-level tokenizer and reads a blank and the text, side B a
    SentencePiece model, which adds that blank.  ``groups`` are the least groups
    of tokens, a and b, that cover the same bytes (with ``notation`` as one text,
    a1,a2|b1;a3|b2,b3); ``pairs`` are the distinct pairs of ids whose tokens
    overlap, and how often (n) they do in the text: n_links times in all.

    Texts that are null or empty, or whose tokens don't spell them (a U+2581 in
    the text, which B takes for a blank), have no tokens.  Repeated rows are kept,
    an empty table gives no rows, other columns are left out.  The models' files
    are read by the driver and broadcast.  A task holds 256 Ki characters at a
    time or one longer text, some 200 bytes a character."""
    with open(a_model, encoding="utf-8") as f, open(b_model, "rb") as g:
        known = docs.sparkSession.sparkContext.broadcast(Tokenizers(json.dumps(json.load(f)), g.read()))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _align(known, steps, notation), "doc_id long, n_a long, n_b long, n_groups long, n_links long, "
        f"groups {'string' if notation else 'array<struct<a:array<int>,b:array<int>>>'}, pairs array<struct<a:int,b:int,n:int>>")


def _packed(a: pa.ListArray, b: pa.ListArray) -> np.ndarray:
    """Pairs of ids as one number."""
    return a.flatten().to_numpy().astype(np.int64) << 32 | b.flatten().to_numpy()


def _add(batches):
    """(pair, n) of a batch, added up."""
    for batch in batches:
        pairs, back = np.unique(_packed(*batch.columns[:2]), return_inverse=True)
        n = np.bincount(back, batch.column(2).flatten().to_numpy(), len(pairs)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])


def _look_up(table, narrow: int):
    """Sums over a text's links whose pairs the table has; the other pairs as they are."""
    def scan(batches):
        pair, total, best = (np.frombuffer(x, t) for x, t in zip(table.value, (np.int64, np.int64, np.bool_)))
        for batch in batches:
            p, n = _packed(*batch.columns[narrow:narrow + 2]), batch.column(narrow + 2).flatten().to_numpy().astype(np.int64)
            bounds = np.concatenate([[0], np.cumsum(np.diff(batch.column(narrow).offsets.to_numpy()))])
            at = np.minimum(np.searchsorted(pair, p), max(len(pair) - 1, 0))
            known = pair[at] == p if len(pair) else np.zeros(len(p), bool)

            def sums(values):
                gone = np.zeros(len(p) + 1, np.int64)
                gone[1:][known] = n[known] * values[at[known]]
                return np.diff(np.cumsum(gone)[bounds])
            rest = pa.StructArray.from_arrays([pa.array(p[~known]), pa.array(n[~known], pa.int64())], names=["pair", "n"])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:narrow], pa.array(sums(best)), pa.array(sums(total)),
                 _lists(rest, np.concatenate([[0], np.cumsum(~known)])[bounds])],
                names=[*batch.schema.names[:narrow], "n_best", "count_sum", "rest"])
    return scan


def _pack(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [pa.array([c.to_numpy(zero_copy_only=False).astype(t).tobytes()], pa.binary()) for c, t in zip(batch.columns, (np.int64, np.int64, np.bool_))],
            names=["pair", "total", "best"])


def notation(groups) -> Column:
    """Groups as one text, as ``align`` gives them with ``notation``."""
    side = lambda g, x: F.array_join(g[x].cast("array<string>"), ",")
    return F.array_join(F.transform(groups, lambda g: F.concat(side(g, "a"), F.lit("|"), side(g, "b"))), ";")


def digest(aligned: DataFrame, table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """One narrow row per document of ``align``'s (with ``notation``): numbers of
    tokens, groups and links, a hash of the groups, the links whose pair is its B id's most frequent partner over all
    documents (n_best), and the sum of their pairs' counts over all documents.

    Each task adds its pairs up before they are counted.  The counts of the most
    frequent pairs, ``table_pairs`` at most, are broadcast; the other pairs of each
    document are joined with theirs, and only their sums go back to the document."""
    spark = aligned.sparkSession
    narrow = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    docs = materialise(aligned.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"),
        F.col("pairs.a").alias("a"), F.col("pairs.b").alias("b"), F.col("pairs.n").alias("n")), "alignment-docs")
    counts = docs.select("a", "b", "n").mapInArrow(_add, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("total"))
    counts = materialise(counts, "alignment-counts").withColumns({"b": F.col("pair") % (1 << 32), "class": F.floor(4 * F.log2("total")).cast("int")})
    # One row for each B id: as many as its vocabulary.
    most = counts.groupBy("b").agg(F.max("total").alias("most"))
    counts = counts.join(F.broadcast(most), "b").select("pair", "total", "class", (F.col("total") == F.col("most")).alias("best"))
    size, least, whole = 0, None, True
    for c in counts.groupBy("class").count().orderBy(F.desc("class")).collect():
        size += c["count"]
        if size > table_pairs:
            whole = False
            break
        least = c["class"]
    often = F.lit(False) if least is None else F.col("class") >= least
    head = counts.where(often).select("pair", "total", "best").mapInArrow(_pack, "pair binary, total binary, best binary").collect()
    pairs, totals, best = (np.concatenate([np.zeros(0, t), *[np.frombuffer(r[k], t) for r in head]]) for k, t in enumerate((np.int64, np.int64, np.bool_)))
    order = np.argsort(pairs)
    table = spark.sparkContext.broadcast([x[order].tobytes() for x in (pairs, totals, best)])
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name in narrow)
    looked = docs.select(*narrow, "a", "b", "n").mapInArrow(
        _look_up(table, len(narrow)), f"{shape}, n_best long, count_sum long, rest array<struct<pair:bigint,n:bigint>>")
    if not whole:
        looked = materialise(looked, "alignment-rest")
        sums = (looked.select("row", F.explode("rest").alias("x")).select("row", "x.*").join(counts.where(~often), "pair")
                .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("total")).alias("more_sum")))
        looked = looked.join(sums, "row", "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    return looked.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
