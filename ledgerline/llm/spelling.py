"""Grouping of spelling variants: k-d trees over letter-count vectors.

One edit changes few counts: a replaced letter lowers one count and raises
another by one (L1 distance 2), an inserted one raises one (L1 distance 1).  So
for each pair of lengths, (l, l) and (l, l + 1), the words near a word lie in a
small box around its vector of letter counts.  A k-d tree finds them: its upper
levels cut the words of one length into cells in Spark, its lower ones are
built in numpy within a cell.  What the boxes can't tell, the order of the
letters, is verified last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut, land, ship, small

LETTERS = r"[a-z\u00C0-\u00FF]+"  # once A-Z are lower-cased
MIN_LETTERS, MIN_COUNT, RATIO = 5, 3, 2
CORRUPT = 97
# Letters of the words of a cell.
CELL = 1 << 18
# Distinct vectors in a leaf of the tree within a cell.
LEAF = 64
# Pairs of vectors compared, and pairs of classes verified, at once; bound memory.
BLOCK, PAIRS = 1 << 20, 1 << 13


def word_counts(docs: DataFrame, least: int = MIN_COUNT, letters: int = MIN_LETTERS, corrupt: int = CORRUPT) -> DataFrame:
    """(word, n): the words of all whole texts with at least ``letters`` code
    points and ``least`` occurrences.

    A run of letters in a document loses one letter where ``corrupt`` divides
    the crc32 of ``<doc_id>:<run>``; a row without an id keeps its runs.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(LETTERS), F.lit(0))).alias("run"))
    # Shorter runs only get shorter still.
    runs = runs.filter(F.char_length("run") >= letters).withColumn(
        "h", F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")).cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    word = F.when(F.col("h") % corrupt == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run"))))
    words = runs.select(F.coalesce(word, "run").alias("word")).filter(F.char_length("word") >= letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


# ------------------------------------------------ upper levels of the trees
def _count(word: Column, letter: Column) -> Column:
    return F.char_length(word) - F.char_length(F.replace(word, letter, F.lit("")))


def _off(word: Column, box: Column) -> tuple[Column, Column]:
    """How much the counts of ``word`` must fall and rise to be in ``box``."""
    def total(part) -> Column:
        return F.aggregate(box, F.lit(0), lambda acc, b: acc + F.greatest(F.lit(0), part(_count(word, b["letter"]), b)))
    return total(lambda c, b: c - b["high"]), total(lambda c, b: b["low"] - c)


BOX = "array<struct<letter: string, low: int, high: int>>"
ANY = 1 << 30


def _route(rows: DataFrame, splits: DataFrame, fall: Column | int, rise: Column | int) -> DataFrame:
    """Send ``rows`` (word, length, cell, ...) whose cell was split on to the
    halves whose box is near enough."""
    kept = rows.join(splits, ["length", "cell"], "left").select(
        *rows.columns, F.explode_outer("halves").alias("_half"))
    down, up = _off(F.col("word"), F.col("_half.box"))
    kept = kept.filter(F.col("_half").isNull() | ((down <= fall) & (up <= rise)))
    return kept.select(*[F.coalesce("_half.cell", "cell").alias("cell") if c == "cell" else c for c in rows.columns])


def _splits(words: DataFrame, boxes: DataFrame, cell_letters: int) -> DataFrame:
    """(length, cell, halves) of every cell with too many letters that a count
    can divide: the letter and count that divide it most evenly.  ``boxes``
    has the (length, cell, box) of cells that were split off."""
    sizes = words.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("size"))
    big = cut(sizes.filter(F.col("size") * F.col("length") > cell_letters).join(boxes, ["length", "cell"], "left")
              .withColumn("box", F.coalesce("box", F.expr(f"cast(array() as {BOX})"))))
    letters = F.explode(F.filter(F.array_distinct(F.split("word", "")), lambda x: x != "")).alias("letter")
    seen = (words.join(small(big.select("length", "cell")), ["length", "cell"]).select("length", "cell", "word", letters)
            .groupBy("length", "cell", "letter", _count(F.col("word"), F.col("letter")).alias("c")).agg(F.count(F.lit(1)).alias("k")))
    # Few counts a letter: the numbers above each threshold from a short list.
    by_letter = seen.groupBy("length", "cell", "letter").agg(F.sort_array(F.collect_list(F.struct("c", "k"))).alias("ks"))
    above = by_letter.select("length", "cell", "letter", "ks", F.explode("ks").alias("x")).select(
        "length", "cell", "letter", F.col("x.c").alias("c"),
        F.aggregate("ks", F.lit(0).cast("long"), lambda acc, y: acc + F.when(y["c"] >= F.col("x.c"), y["k"]).otherwise(0)).alias("above"))
    best = (above.join(small(big), ["length", "cell"]).filter(F.col("above") < F.col("size"))
            .groupBy("length", "cell").agg(
                F.min_by(F.struct("letter", "c"), F.struct(F.abs(F.col("above") * 2 - F.col("size")), "letter", "c")).alias("s"),
                F.first("box").alias("box")))

    def half(low: Column, high: Column, bit: int) -> Column:
        old = F.get(F.filter("box", lambda x: x["letter"] == F.col("s.letter")), F.lit(0))
        rest = F.filter("box", lambda x: x["letter"] != F.col("s.letter"))
        own = F.struct(F.col("s.letter").alias("letter"), F.greatest(low.cast("int"), F.coalesce(old["low"], F.lit(0))).alias("low"),
                       F.least(high.cast("int"), F.coalesce(old["high"], F.lit(ANY))).alias("high"))
        return F.struct((F.col("cell") * 2 + bit).alias("cell"), F.concat(rest, F.array(own)).alias("box"))
    return cut(best.select("length", "cell", F.array(half(F.lit(0), F.col("s.c") - 1, 0), half(F.col("s.c"), F.lit(ANY), 1)).alias("halves")))


# ----------------------------------------------------------- within a cell
def _vectors(words: np.ndarray) -> np.ndarray:
    """Letter counts (word, 256) of equally long words, as bytes of Latin-1,
    in (word, length)."""
    kind = np.int8 if words.shape[1] < 120 else np.int32
    out = np.zeros((len(words), 256), kind)
    for i in range(words.shape[1]):
        out[np.arange(len(words)), words[:, i]] += 1
    return out


class _Tree:
    """A k-d tree over the distinct vectors of a cell."""

    def __init__(self, points: np.ndarray):
        self.points, self.order = points, np.arange(len(points))
        self.top = points.max(0)
        self.unary = self.in_unary(points)
        self.nodes: list[tuple] = []  # (from, to, low, high, children or None)
        self._build(0, len(points))

    def in_unary(self, vectors: np.ndarray) -> np.ndarray:
        """Each count as that many ones of the most that points have, so that
        a product tells how many letters two words have in common."""
        return np.concatenate([(vectors[:, k, None] > np.arange(n)).astype(np.float32) for k, n in enumerate(self.top)], 1)

    def _build(self, a: int, b: int) -> int:
        at, own = len(self.nodes), self.points[self.order[a:b]]
        low, high = own.min(0), own.max(0)
        self.nodes.append((a, b, low, high, None))
        if b - a > LEAF:
            k = int(own.astype(np.float32).var(0).argmax())
            right = own[:, k] > int(np.median(own[:, k]))
            if not right.any():  # the median is the most
                right = own[:, k] == high[k]
            self.order[a:b] = np.concatenate([self.order[a:b][~right], self.order[a:b][right]])
            middle = a + int((~right).sum())
            self.nodes[at] = (a, b, low, high, (self._build(a, middle), self._build(middle, b)))
        return at

    def near(self, queries: np.ndarray, fall: np.ndarray, common: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, point) numbers of vectors with ``common`` letters in common.
        A box is searched if at most ``fall`` (of each query) counts must fall
        and one rise to be in it."""
        unary = self.in_unary(queries)
        todo = [(0, np.arange(len(queries)))]
        while todo:
            node, own = todo.pop()
            a, b, low, high, children = self.nodes[node]
            q = queries[own]
            own = own[(np.maximum(q - high, 0).sum(1) <= fall[own]) & (np.maximum(low - q, 0).sum(1) <= 1)]
            if not len(own):
                continue
            if children:
                todo += [(c, own) for c in children]
                continue
            points = self.order[a:b]
            own_unary, step = self.unary[points].T, max(1, BLOCK // len(points))
            for s in range(0, len(own), step):
                i, j = np.nonzero(unary[own[s:s + step]] @ own_unary == common)
                yield own[s + i], points[j]


def _removals(words: np.ndarray) -> np.ndarray:
    """Hashes (word, position) of each word without the letter there."""
    length = words.shape[1]
    base = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        power = np.ones(length, np.uint64)
        for i in range(1, length):
            power[i] = power[i - 1] * base
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        code = (words.astype(np.uint64) + np.uint64(1)) * power
        before = np.cumsum(code, 1) - code
        after = (code.sum(1, keepdims=True) - before - code) * inverse
        return before + after


def _positions(words: np.ndarray, classes: list[np.ndarray], pair: np.ndarray, cls: np.ndarray, letter: np.ndarray):
    """For pairs with a class of words each: (pair, word, position) of every
    ``letter`` in its words."""
    size = np.array([len(classes[c]) for c in cls])
    word = np.concatenate([classes[c] for c in cls]) if len(cls) else np.zeros(0, int)
    p = np.repeat(np.arange(len(cls)), size)
    row, at = np.nonzero(words[word] == letter[p][:, None])
    return pair[p[row]], word[row], at


def _verified(qw: np.ndarray, qc: list[np.ndarray], qv: np.ndarray, pw: np.ndarray, pc: list[np.ndarray], pv: np.ndarray,
              qi: np.ndarray, pi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query word, point word) numbers that are one edit apart, among the
    words of the class pairs (qi, pi).

    Without the letter that differs the words must be the same.  For a pair
    of classes the removals of both sides meet by hash, so the work grows with
    the words and not with their pairs; equal hashes are compared in full.
    """
    diff = pv[pi].astype(np.int32) - qv[qi]
    if pw.shape[1] == qw.shape[1]:  # two classes find each other; the one that has the smaller letter asks
        asks = diff.argmin(1) < diff.argmax(1)
        qi, pi, diff = qi[asks], pi[asks], diff[asks]
    if not len(qi):
        return qi, pi
    pair = np.arange(len(qi))
    b_pair, b_word, b_at = _positions(pw, pc, pair, pi, diff.argmax(1))  # the letter that points have more
    b_key = _removals(pw)[b_word, b_at]
    if pw.shape[1] == qw.shape[1]:
        a_pair, a_word, a_at = _positions(qw, qc, pair, qi, diff.argmin(1))
        a_key = _removals(qw)[a_word, a_at]
        a_tag, b_tag = ((p * pw.shape[1] + at).astype(np.uint64) for p, at in ((a_pair, a_at), (b_pair, b_at)))
    else:  # the query is the point without that letter
        size = np.array([len(qc[c]) for c in qi])
        a_pair, a_word = np.repeat(pair, size), np.concatenate([qc[c] for c in qi])
        a_key = _removals(np.concatenate([qw, np.zeros((len(qw), 1), np.uint8)], 1))[a_word, qw.shape[1]]
        a_tag, b_tag = a_pair.astype(np.uint64), b_pair.astype(np.uint64)
    with np.errstate(over="ignore"):
        mix = np.uint64(0xD6E8FEB86659FD93)
        a_all, b_all = a_key + a_tag * mix, b_key + b_tag * mix
    order = np.argsort(b_all, kind="stable")
    lo, hi = np.searchsorted(b_all[order], a_all, "left"), np.searchsorted(b_all[order], a_all, "right")
    n = hi - lo
    a = np.repeat(np.arange(len(a_all)), n)
    b = order[np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))]
    ok = a_pair[a] == b_pair[b]
    x, y = a_word[a[ok]], b_word[b[ok]]
    if pw.shape[1] == qw.shape[1]:
        same = (qw[x] != pw[y]).sum(1) == 1
    else:  # equal up to some place, and from there on by one letter
        p = pw[y]
        head = np.cumprod(qw[x] == p[:, :-1], 1).sum(1)
        tail = np.cumprod((qw[x] == p[:, 1:])[:, ::-1], 1).sum(1)
        same = head + tail >= qw.shape[1]
    found = np.unique(np.stack([x[same], y[same]], 1), axis=0)
    return found[:, 0], found[:, 1]


def _classes(words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct vectors, and the words that have each."""
    key = np.ascontiguousarray(np.sort(words, 1)).view(f"V{words.shape[1]}").ravel()
    first, inverse = np.unique(key, return_index=True, return_inverse=True)[1:]
    order = np.argsort(inverse, kind="stable")
    return _vectors(words[first]), np.split(order, np.cumsum(np.bincount(inverse))[:-1])


def _matrix(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


FOUND = pa.schema([("a", pa.string()), ("b", pa.string())])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of the cells of one task.  Rows come ordered by piece, its
    points first, then the queries by length; queries are read in parts, so a
    task holds the points of one piece and some queries."""
    piece, points, waiting, size = None, [], [], 0

    def answer() -> Iterator[pa.RecordBatch]:
        nonlocal waiting, size
        queries, waiting, size = waiting, [], 0
        if not queries or not points:
            return
        if built[0] is None:
            pw = _matrix(points)
            pv, pc = _classes(pw)
            used = np.flatnonzero(pv.any(0))
            built[0] = pw, pv, pc, used, _Tree(np.ascontiguousarray(pv[:, used]))
        pw, pv, pc, used, tree = built[0]
        by_length: dict[int, list[bytes]] = {}
        for w in queries:
            by_length.setdefault(len(w), []).append(w)
        for length, own in by_length.items():
            qw = _matrix(own)
            qv, qc = _classes(qw)
            same = length == pw.shape[1]
            # Letters that no point has must fall too.
            fall = int(same) - (qv.sum(1, dtype=np.int64) - qv[:, used].sum(1, dtype=np.int64))
            fits = np.flatnonzero(fall >= 0)
            hits: list[tuple] = []
            held = 0

            def verify() -> pa.RecordBatch:
                qi, pi = (np.concatenate([h[k] for h in hits]) for k in (0, 1))
                x, y = _verified(qw, qc, qv, pw, pc, pv, qi, pi)
                return pa.RecordBatch.from_pydict({"a": [own[i].decode("latin-1") for i in x], "b": [points[j].decode("latin-1") for j in y]},
                                                  schema=FOUND)

            for i, j in tree.near(np.ascontiguousarray(qv[fits][:, used]), fall[fits], length - int(same)):
                hits.append((fits[i], j))
                held += len(i)
                if held >= PAIRS:
                    yield verify()
                    hits, held = [], 0
            if held:
                yield verify()

    built = [None]
    for batch in batches:
        for p, query, w in zip(batch["piece"].to_pylist(), batch["query"].to_pylist(), batch["word"].to_pylist()):
            if p != piece:
                yield from answer()
                piece, points, built[0] = p, [], None
            w = w.encode("latin-1")
            if not query:
                points.append(w)
                continue
            waiting.append(w)
            size += len(w)
            if size >= CELL:
                yield from answer()
    yield from answer()


def near_pairs(words: DataFrame, cell_letters: int = CELL) -> DataFrame:
    """(a, b): all pairs of the distinct ``word``s that are one inserted,
    deleted or replaced letter apart, each once.

    Cells hold words of one length.  A cell whose words all have one vector
    can't be divided by counts, and none of its words are near one another;
    such cells are dealt into pieces by a hash of the word instead.  A word is
    a point of one piece, and asks every piece of the cells that its box of
    the same length and of the next one reaches.
    """
    length = F.char_length("word")
    points = words.select("word", length.alias("length"), F.lit(1).cast("long").alias("cell"))
    asks = points.select("word", F.explode(F.array(F.col("length"), F.col("length") + 1)).alias("length"), "cell")
    same = F.char_length("word") == F.col("length")
    boxes = points.select("length", "cell", F.expr(f"cast(array() as {BOX})").alias("box")).limit(0)
    while not (splits := _splits(points, boxes, cell_letters)).isEmpty():
        points = cut(_route(points, small(splits), 0, 0))
        asks = _route(asks, small(splits), F.when(same, 1).otherwise(0), 1)
        boxes = splits.select("length", F.inline("halves"))
    sizes = cut(points.groupBy("length", "cell").agg(
        F.ceil(F.count(F.lit(1)) * F.col("length") / cell_letters).cast("int").alias("pieces")))
    name = F.concat_ws(":", "length", "cell", "part")
    own = points.join(small(sizes), ["length", "cell"]).withColumn("part", F.pmod(F.xxhash64("word"), F.col("pieces")))
    sent = asks.join(small(sizes), ["length", "cell"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    tasks = sizes.agg(F.sum("pieces")).first()[0] or 1
    rows = own.select(name.alias("piece"), F.lit(False).alias("query"), "word").unionByName(
        sent.select(name.alias("piece"), F.lit(True).alias("query"), "word"))
    return rows.repartition(tasks, "piece").sortWithinPartitions("piece", "query").mapInArrow(_search, "a string, b string")


# ------------------------------------------------------------------- groups
def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form), following forms to the last.

    Each round follows twice as many links.  A form has at least RATIO times
    the occurrences of its word, so chains are short and without rings.
    """
    links = cut(forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        longer = cut(links.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        links = longer.select("word", "root")
        if longer.filter("moved").isEmpty():
            break
    return forms.select("word").join(links, "word", "left").select("word", F.coalesce("root", "word").alias("root"))


def variants(counts: DataFrame, ratio: int = RATIO, cell_letters: int = CELL) -> DataFrame:
    """(word, n, form, form_n, root, n_near) of every (word, n).

    ``form`` is the near word with the most occurrences (ties: the first by
    code points) if those are at least ``ratio`` times the word's.
    """
    counts = land(counts.select("word", F.col("n").cast("long").alias("n")), "words")
    pairs = land(near_pairs(counts.select("word"), cell_letters), "near")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = counts.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    # A word's best neighbour is an aggregate with a map-side step.
    best = both.join(other, "b").groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("k"), F.col("b").alias("form"))).alias("best"))
    most = -F.col("best.k")
    enough = most >= F.lit(ratio) * F.col("n")
    out = land(counts.join(best, "word", "left").select(
        "word", "n", F.when(enough, F.col("best.form")).alias("form"), F.when(enough, most).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")), "forms")
    return out.join(roots(out.select("word", "form")), "word").select("word", "n", "form", "form_n", "root", "n_near")


def document_variants(docs: DataFrame) -> DataFrame:
    """The variants among the words of whole ``documents`` texts.

    Null and empty texts have no words; repeated rows count again; words that
    tie go by code points; an empty table gives no rows; other columns of the
    input play no part.
    """
    return variants(word_counts(docs.select("doc_id", "text")))


ship(__name__)
