"""Alignment of two tokenizers by divide and conquer at shared cuts, and how often tokens end together.

Both tokenizers cut the same bytes, a text behind one space. An offset where a token of each ends is a
shared cut. An interval between two shared cuts is searched for one near its middle: the end of
the middle token of the first tokenizer is looked up among the ends of the second by bisection, and
if it's none of them, the nearest common end is taken. Both halves go the same way; an
interval without a cut inside is a group. All intervals of a batch of texts go down a level at once.

The two tokens that end at a cut are linked. How many links hold an id pair in all the corpus
is counted from each document's distinct pairs. Pairs with at least the ``BROADCAST_PAIRS``-th part of all
links, of which there are no more than that number, meet the documents by broadcast; the others, none
of which is frequent, by a shuffle. So no join is skewed, whatever the vocabulary and the corpus.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import Remembered, Store, per_process
from oreflow.llm.packing import Encoder

#: Bytes of text aligned at once; a longer text is aligned alone.
ALIGNED = 1 << 20
#: Bytes in which a worker remembers the words of one tokenizer.
REMEMBERED = 128 << 20
BROADCAST_PAIRS = 200_000


def byte_letters() -> dict[str, int]:
    """The letter a byte-level vocabulary writes for each byte: printable ones themselves, the rest from 256 on in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class Words(Remembered):
    """A word to its ids, 32-bit, as it is encoded behind one space."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]]):
        super().__init__(REMEMBERED)
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        made = self.recall(word)
        if made is None:
            if not word:
                raise LookupError(word)
            made = array("i", self.encode([word])[0]).tobytes()
            self.keep(word, made)
        return made

    def learn(self, texts: list[str]) -> None:
        """Encode the words of the texts that aren't remembered, all at once."""
        words = {w for t in texts for w in t.split(" ")}.difference(self.keys())
        new = [w for w in words if 0 < len(w) <= self.longest and self.recall(w) is None]
        for word, ids in zip(new, self.encode(new), strict=True):
            self.keep(word, array("i", ids).tobytes())


class Side:
    """One tokenizer: ids of a text behind one space, and the bytes of each id.

    Neither of the two kinds lets a token reach over the place between a character that is no white space and
    one space behind it, so words between single spaces are encoded apart and remembered (``words`` raises
    LookupError for others). Any other text is encoded whole.
    """

    def __init__(self, encode: Callable[[str], list[int]], spelled: list[bytes], words: Mapping[str, bytes]):
        self.encode, self.words = encode, words
        self.sizes = np.array([len(b) for b in spelled], dtype=np.int64)
        self.begins, self.flat = np.cumsum(self.sizes) - self.sizes, np.frombuffer(b"".join(spelled), dtype=np.uint8)

    def learn(self, texts: list[str]) -> None:
        if isinstance(self.words, Words):
            self.words.learn(texts)

    def ids(self, text: str) -> np.ndarray:
        try:
            ids = array("i", b"".join(map(self.words.__getitem__, text.split(" "))))
        except LookupError:
            ids = array("i", self.encode(text))
        return np.array(ids, dtype=np.int64)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens in a row."""
        sizes = self.sizes[ids]
        return self.flat[np.repeat(self.begins[ids] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]


def byte_level(path: str) -> Side:
    """A tokenizers file of the byte-level kind. It gets the space; names of special tokens in a text are text."""
    encoder, letters = Encoder(path), byte_letters()
    tokenizer = encoder.tokenizer
    tokenizer.encode_special_tokens = True
    spelled = [bytes(letters[c] for c in tokenizer.id_to_token(i)) for i in range(tokenizer.get_vocab_size())]
    return Side(lambda text: tokenizer.encode(" " + text, add_special_tokens=False).ids, spelled, encoder.rest)


def piece(path: str) -> Side:
    """A sentencepiece model, which adds the space itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    spelled = [bytes([int(n[1:-1], 16)]) if model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
    encode = lambda text: model.encode(text, num_threads=1)  # noqa: E731  a text or a list of texts
    return Side(encode, spelled, Words(encode))


def shared_cuts(a: np.ndarray, b: np.ndarray, a_lo: np.ndarray, a_hi: np.ndarray, b_lo: np.ndarray, b_hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b``, both rising ends of tokens, of all ends in common.

    Interval k is the tokens ``a_lo[k]`` to ``a_hi[k] - 1`` of one and ``b_lo[k]`` to ``b_hi[k] - 1`` of the other,
    whose last tokens end together.
    """
    found_a, found_b = [a_hi - 1], [b_hi - 1]
    while True:
        inner = (a_hi - a_lo > 1) & (b_hi - b_lo > 1)  # else no token ends inside on both sides: a leaf
        a_lo, a_hi, b_lo, b_hi = a_lo[inner], a_hi[inner], b_lo[inner], b_hi[inner]
        if not len(a_lo):
            return np.sort(np.concatenate(found_a)), np.sort(np.concatenate(found_b))
        middle = (a_lo + a_hi) // 2 - 1
        at = np.searchsorted(b, a[middle])
        hit = b[at] == a[middle]
        missed = np.flatnonzero(~hit)
        if len(missed):  # the common end nearest to the middle, if the interval has one
            n = a_hi[missed] - 1 - a_lo[missed]
            of = np.repeat(missed, n)
            i = a_lo[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            j = np.searchsorted(b, a[i])
            common = b[j] == a[i]
            of, i, j = of[common], i[common], j[common]
            order = np.lexsort((np.abs(i - middle[of]), of))
            of, i, j = of[order], i[order], j[order]
            first = np.concatenate(([True], of[1:] != of[:-1])) if len(of) else np.zeros(0, dtype=bool)
            middle[of[first]], at[of[first]], hit[of[first]] = i[first], j[first], True
        a_lo, a_hi, b_lo, b_hi, middle, at = (x[hit] for x in (a_lo, a_hi, b_lo, b_hi, middle, at))
        found_a.append(middle)
        found_b.append(at)
        # Halves side by side: intervals stay in order, and so do the ends looked up.
        a_lo, a_hi = np.stack((a_lo, middle + 1), axis=1).ravel(), np.stack((middle + 1, a_hi), axis=1).ravel()
        b_lo, b_hi = np.stack((b_lo, at + 1), axis=1).ravel(), np.stack((at + 1, b_hi), axis=1).ravel()


def _text(content: bytes) -> str:
    try:
        return content.decode()
    except UnicodeDecodeError:
        return ""


class Aligner:
    """Aligns batches of texts: for each the numbers of tokens, the groups as text and the distinct linked pairs."""

    def __init__(self, one: Side, other: Side):
        self.one, self.other = one, other
        most = max(len(one.sizes), len(other.sizes))
        self.parts = [f"{i}{sign}".encode() for i in range(most) for sign in ",|;"]

    def __call__(self, contents: list[bytes]) -> list[tuple[int, int, bytes, np.ndarray, np.ndarray]]:
        none = np.empty(0, dtype=np.int64)
        out, a_ids, b_ids, rows = [(0, 0, b"", none, none)] * len(contents), [], [], []
        texts = [_text(c) for c in contents]
        for side in (self.one, self.other):
            side.learn([t for t in texts if t])
        for k, text in enumerate(texts):
            if text:
                x, y, size = self.one.ids(text), self.other.ids(text), len(contents[k]) + 1
                if self.one.sizes[x].sum() == size == self.other.sizes[y].sum():
                    a_ids.append(x)
                    b_ids.append(y)
                    rows.append(k)
        for ids, side in ((a_ids, self.one), (b_ids, self.other)):  # the tokens must spell the texts
            whole = np.frombuffer(b"".join([b" " + contents[k] for k in rows]), dtype=np.uint8)
            odd = np.flatnonzero(whole != side.spelled(np.concatenate(ids))) if ids else np.empty(0)
            bad = set(np.searchsorted(np.cumsum([len(contents[k]) + 1 for k in rows]), odd, side="right").tolist())
            a_ids, b_ids, rows = ([x for n, x in enumerate(xs) if n not in bad] for xs in (a_ids, b_ids, rows))
        if not rows:
            return out
        a_cut, b_cut = (np.cumsum([0, *map(len, x)]) for x in (a_ids, b_ids))
        a_ids, b_ids = np.concatenate(a_ids), np.concatenate(b_ids)
        cut_a, cut_b = shared_cuts(np.cumsum(self.one.sizes[a_ids]), np.cumsum(self.other.sizes[b_ids]), a_cut[:-1], a_cut[1:], b_cut[:-1], b_cut[1:])
        # All in the order a1,a2|b1;a3|b2,b3; with a sign behind each id: 0 for ',', 1 for '|', 2 for ';'.
        a_last, b_last = np.zeros(len(a_ids), dtype=np.int64), np.zeros(len(b_ids), dtype=np.int64)
        a_last[cut_a], b_last[cut_b] = 1, 1
        b_before = np.concatenate(([0], cut_b[:-1] + 1))
        spelled = np.empty(len(a_ids) + len(b_ids), dtype=np.int64)
        spelled[np.arange(len(a_ids)) + b_before[np.cumsum(a_last) - a_last]] = 3 * a_ids + a_last
        spelled[np.arange(len(b_ids)) + (cut_a + 1)[np.cumsum(b_last) - b_last]] = 3 * b_ids + 2 * b_last
        pairs = a_ids[cut_a] << 32 | b_ids[cut_b]
        links = np.searchsorted(cut_a, a_cut - 1, side="right")  # links before each text's end
        for n, k in enumerate(rows):
            x, y = a_cut[n], b_cut[n]
            groups = b"".join(map(self.parts.__getitem__, spelled[x + y : a_cut[n + 1] + b_cut[n + 1]].tolist()))[:-1]
            out[k] = (int(a_cut[n + 1] - x), int(b_cut[n + 1] - y), groups, *np.unique(pairs[links[n] : links[n + 1]], return_counts=True))
        return out


def align(docs: DataFrame, byte_level_path: str, piece_path: str) -> DataFrame:
    """doc_id, n_a, n_b, groups, pairs, times of each document.

    ``groups`` is the alignment, decimal ids as in ``a1,a2|b1;a3|b2,b3``; ``pairs`` the distinct linked ids of the
    document, the first tokenizer's in the upper 32 bits, and ``times`` how often each is linked there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = per_process(f"aligner:{byte_level_path}:{piece_path}", lambda: Aligner(byte_level(byte_level_path), piece(piece_path)))

        def made(ids: list[int | None], contents: list[bytes]) -> pa.RecordBatch:
            n_a, n_b, groups, pairs, times = zip(*own(contents), strict=True)
            ends = pa.array(np.cumsum([0, *map(len, pairs)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x).astype(np.int64))) for x in (pairs, times)]
            columns = [pa.array(ids, pa.int64()), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(groups, pa.binary()).cast(pa.string()), *lists]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "groups", "pairs", "times"])

        for batch in batches:
            ids, contents, size = [], [], 0
            for i, content in zip(batch.column("doc_id"), batch.column("content"), strict=True):
                content = content.as_py()
                if contents and size + len(content) > ALIGNED:
                    yield made(ids, contents)
                    ids, contents, size = [], [], 0
                ids.append(i.as_py())
                contents.append(content)
                size += len(content)
            if contents:
                yield made(ids, contents)

    content = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("content")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), content)
    return rows.mapInArrow(run, "doc_id long, n_a long, n_b long, groups string, pairs array<long>, times array<long>")


def pair_counts(links: DataFrame, store: Store) -> DataFrame:
    """pair, total (links in all the corpus), best (no id is linked to the second one more often)."""
    counts = links.groupBy("pair").agg(F.sum("times").alias("total"))
    second = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))  # a vocabulary's length of rows at most
    return store.put("counts", counts.withColumn("best", F.col("total") == F.max("total").over(second)))


def alignment(docs: DataFrame, byte_level_path: str, piece_path: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """A row for each document with its tokens, groups and links.

    A null or empty text, one that is no UTF-8 and one whose tokens don't spell it has no tokens and no groups ('').
    Texts are taken whole. Rows that repeat a document count each for itself; a null id is like any other.
    Ties for the most frequent link of an id count all. Other columns are ignored; an empty table gives no rows.

    Returns doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 ('' without tokens).
    """
    store = Store(docs.sparkSession, "alignment")
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    rows = store.put("aligned", align(docs, byte_level_path, piece_path).select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", digest, "pairs", "times"))
    links = rows.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    counts = pair_counts(links, store)
    least = counts.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n")).first()["n"] / broadcast_pairs
    frequent, rare = counts.where(F.col("total") >= least), counts.where(F.col("total") < least)
    met = links.join(F.broadcast(frequent), "pair").unionByName(links.join(F.broadcast(frequent.select("pair")), "pair", "left_anti").join(rare, "pair"))
    sums = met.groupBy("row").agg(
        F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("total")).alias("count_sum")
    )
    # Each group ends with one link.
    number = lambda name: F.coalesce(name, F.lit(0)).alias(name)
    found = rows.drop("pairs", "times").join(sums, "row", "left")
    return found.select("doc_id", "n_a", "n_b", F.coalesce("n_links", F.lit(0)).alias("n_groups"), number("n_links"), number("n_best"), number("count_sum"), "groups_sha256")
