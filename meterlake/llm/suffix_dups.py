"""Exact removal of repeated passages through a distributed difference-cover suffix order.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere
else. The suffixes that matter are ordered by the difference-cover algorithm
(triples at places 1 and 2 modulo 3 are sorted and named, the names are ordered
by recursion, the remaining suffixes are merged in), and neighbours in the
order compare their prefixes of ``length`` bytes.

The order is not built over single bytes but over *anchors*. The anchor of a
window of ``length`` bytes is the place, among its first ``w``, of the smallest
hash of ``k`` bytes: it depends on the window's content alone, so equal windows
hold their anchors at equal distances. The text from an anchor on, as a string
of symbols, has one symbol per anchor: the rank of the bytes that start there
and that all its windows hold. Their first ``w + k`` fix where the next anchor
lies, so the order of symbol strings is the order of the texts. Places between
anchors are the remaining suffixes: they sort by the bytes up to their anchor,
then by the anchor's rank.

Two exact conditions keep the work small. All windows of an anchor hold the
``length - w + 1`` bytes after it; if those are unique, none repeats. And if two
anchors agree in all the bytes that their windows hold, all of them repeat.
What is left are the edges of repeated passages.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import discard, doc_rows, numbered, stored
from meterlake.plans.joins import lookup_join
from meterlake.session import ship_package

LENGTH = 400
BLOCK = 1 << 20       # window starts hashed at once
GROUP = 1 << 16       # bytes of short texts hashed at once
LOW = (1 << 22) - 1   # bits of a place in a block
KEY = ["k1", "k2"]    # the halves of a text's MD5
ANCHOR = "k1 long, k2 long, t int, lo int, hi int, f long, x1 long, x2 long"


@dataclass(frozen=True)
class Scheme:
    """Sizes derived from the length of a repeat."""

    length: int = LENGTH

    @property
    def k(self) -> int:
        return max(1, min(16, self.length // 4))

    @property
    def w(self) -> int:
        return max(1, (self.length - self.k) // 3)

    @property
    def ahead(self) -> int:
        """Bytes after an anchor that all its windows hold."""
        return self.length - self.w + 1

    @property
    def reach(self) -> int:
        """Bytes after an anchor that fix the next one."""
        return self.w + self.k

    @property
    def symbol(self) -> int:
        """Bytes of a symbol: all that the windows of its anchor share, never fewer than ``reach``."""
        return self.ahead


class Hashes:
    """Hashes of all substrings of a byte array by running sums modulo 2**64 (two independent ones)."""

    def __init__(self, np, size: int):
        self.np = np
        rng = np.random.default_rng(400)
        self.tables = [rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2)]
        base = 0x9E3779B97F4A7C15
        self.up = self._powers(base, size)
        self.down = self._powers(pow(base, -1, 2**64), size)
        self.places = np.arange(size + 1, dtype=np.uint64)

    def _powers(self, base, size):
        out = self.np.full(size + 1, base, self.np.uint64)
        out[0] = 1
        return self.np.multiply.accumulate(out)

    def sums(self, data, which=0):
        out = self.np.zeros(len(data) + 1, self.np.uint64)
        values = self.tables[which].take(data, mode="clip")
        values *= self.up[:len(data)]
        self.np.cumsum(values, out=out[1:])
        return out

    def grams(self, sums, k):
        """Hash of every ``k`` bytes, to be compared by its high bits."""
        x = sums[k:] - sums[:-k]
        x *= self.down[:len(x)]
        x ^= x >> self.np.uint64(32)
        x *= self.np.uint64(0xD6E8FEB86659FD93)
        return x

    def between(self, sums, a, b, salt=None):
        """Hash of data[a:b] for arrays of places; ``salt`` tells apart what the bytes don't."""
        np = self.np
        x = (sums[b] - sums[a]) * self.down[a]
        if salt is not None:
            x = x + salt.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xE7037ED1A0B428DB)
        return x ^ (x >> np.uint64(32))


class Parser:
    """Anchors of texts (helper of the Arrow stages; made once per task)."""

    def __init__(self, scheme: Scheme):
        self.scheme = scheme

    @cached_property
    def np(self):
        import numpy as np

        return np

    @cached_property
    def hashes(self):
        return Hashes(self.np, BLOCK + 2 * self.scheme.length + 64)

    def _block(self, data: bytes):
        """(sums, anchor of each window start) of some bytes."""
        np, s = self.np, self.scheme
        sums = self.hashes.sums(np.frombuffer(data, np.uint8))
        low = np.uint64(LOW)
        # Smallest hash, then the leftmost place: the place fills the low bits.
        best = self.hashes.grams(sums, s.k)
        best &= ~low
        best |= self.hashes.places[:len(best)]
        done = 1
        while done * 2 <= s.w:
            best = np.minimum(best[:-done], best[done:])
            done *= 2
        if done < s.w:
            best = np.minimum(best[:done - s.w], best[s.w - done:])
        best &= low
        return sums, best.view(np.int64)

    def anchors(self, texts):
        """Blocks of (which, t, lo, hi, f, x1, x2): each anchor of each text with the run of window starts that it serves."""
        length, held, size = self.scheme.length, [], 0
        for which, text in enumerate(texts):
            starts = len(text) - length + 1
            for first in range(0, max(0, starts), BLOCK):
                part = text[first:min(starts, first + BLOCK) + length - 1]
                if held and size + len(part) > GROUP:
                    yield self._anchors(held)
                    held, size = [], 0
                held.append((which, first, part))
                size += len(part)
        if held:
            yield self._anchors(held)

    def _anchors(self, held):
        """Anchors of parts of texts, hashed as one string; no window lies across two parts."""
        np, s = self.np, self.scheme
        which, first = (np.array(c) for c in list(zip(*held, strict=True))[:2])
        size = np.array([len(part) for _, _, part in held])
        base, n = np.cumsum(size) - size, size - s.length + 1
        data = b"".join(part for _, _, part in held)
        sums, at = self._block(data)
        place = np.arange(int(n.sum())) + np.repeat(base - (np.cumsum(n) - n), n)
        at = at[place]
        new = np.flatnonzero(at[1:] != at[:-1])
        lo, hi, t = place[np.append(0, new + 1)], place[np.append(new, len(at) - 1)], at[np.append(0, new + 1)]
        end, shape = hi + s.length, (t - lo) * 65536 + (hi - lo)
        owner = np.searchsorted(base, lo, "right") - 1
        shift = (first - base)[owner]
        more = self.hashes.sums(np.frombuffer(data, np.uint8), 1)
        return (which[owner], t + shift, lo + shift, hi + shift, self.hashes.between(sums, t, t + s.ahead),
                self.hashes.between(sums, lo, end, shape), self.hashes.between(more, lo, end, shape))

    def places(self, text: bytes):
        """All anchors of a text in order, up to where no whole window of hashes is left."""
        np, s = self.np, self.scheme
        starts = len(text) - s.reach + 2
        found = [np.zeros(0, np.int64)]
        for first in range(0, max(0, starts), BLOCK):
            last = min(starts, first + BLOCK)
            at = self._block(text[first:last + s.reach - 2])[1]
            found.append(at[np.append(True, at[1:] != at[:-1])] + first)
        return np.unique(np.concatenate(found))

    def windows(self, text: bytes, t, lo, hi, rank):
        """Blocks of (group, rank, digest, i): the window starts of the given anchors, which are in order.

        ``group`` is the hash of the bytes up to the anchor and a few after it,
        ``digest`` that of the window's ``length`` bytes.
        """
        np, s = self.np, self.scheme
        spread = min(16, s.ahead)
        a = 0
        while a < len(t):
            first = int(lo[a])
            z = max(a + 1, int(np.searchsorted(hi, first + BLOCK, "right")))
            sums = self.hashes.sums(np.frombuffer(text[first:int(hi[z - 1]) + s.length], np.uint8))
            n = hi[a:z] - lo[a:z] + 1
            i = np.arange(int(n.sum())) + np.repeat(lo[a:z] - first - (np.cumsum(n) - n), n)
            at = np.repeat(t[a:z] - first, n)
            yield (self.hashes.between(sums, i, at + spread, at - i), np.repeat(rank[a:z], n),
                   self.hashes.between(sums, i, i + s.length), i + first)
            a = z


def _lists(np, column):
    """Per row a dict of arrays: the fields of a list of structs, without Python objects for its entries."""
    offsets = column.offsets.to_numpy()
    fields = {f.name: column.values.field(f.name).to_numpy(zero_copy_only=False) for f in column.type.value_type}
    for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield {name: x[a:z] for name, x in fields.items()}


def _long(np, a):
    import pyarrow as pa

    return pa.array(np.ascontiguousarray(a).view(np.int64))


def _together(np, rows, size: int = 100_000):
    """The tuples of arrays put together to ``size`` entries or more."""
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += len(r[0])
        if n >= size:
            yield [np.concatenate(c) for c in zip(*held, strict=True)]
            held, n = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def find_anchors(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """Every anchor of every text of at least ``length`` bytes; ``k1`` and ``k2`` are the halves of the text's MD5."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        parser = Parser(scheme)

        def found():
            for b in batches:
                k1, k2 = b.column("k1").to_numpy(), b.column("k2").to_numpy()
                for which, *rest in parser.anchors(text.as_py() for text in b.column("text")):
                    yield k1[which], k2[which], *rest

        for k1, k2, t, lo, hi, *hashes in _together(np, found()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1), pa.array(k2), *[pa.array(c.astype(np.int32)) for c in (t, lo, hi)],
                 *[_long(np, c) for c in hashes]], [*KEY, "t", "lo", "hi", "f", "x1", "x2"])

    ship_package(docs.sparkSession)
    return _keyed(docs).where(F.octet_length("text") >= scheme.length).mapInArrow(run, ANCHOR)


def _joined(run, rows: int = 100_000):
    """``run`` with its small batches put together."""
    def gathered(batches):
        import pyarrow as pa

        held, size = [], 0
        for b in run(batches):
            held.append(b)
            size += b.num_rows
            if size >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return gathered


def _key(text) -> list:
    digest = F.md5(text)
    return [F.conv(F.substring(digest, 16 * half + 1, 16), 16, -10).cast("long").alias(KEY[half]) for half in range(2)]


def _keyed(docs: DataFrame, *more: str) -> DataFrame:
    """The key and the bytes of each text, a null one being empty."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    return doc_rows(docs).select(*more, *_key(text), text.alias("text"))


def _symbols(texts: DataFrame, scheme: Scheme) -> DataFrame:
    """(dn, s, j, t, e, prefix): the anchors of each segment in order.

    A segment runs from a wanted anchor until its symbols cover the ``length`` bytes
    from the last wanted one on, or the text ends; ``s`` is its first place.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa

        parser = Parser(scheme)
        for b in batches:
            for dn, text, wanted in zip(b.column("dn").to_pylist(), b.column("text"), _lists(np, b.column("wanted")), strict=True):
                data = text.as_py()
                places = parser.places(data)
                want = np.unique(wanted["t"].astype(np.int64))
                first = np.searchsorted(places, want)
                # The last symbol that a wanted place needs is the first to reach the end of its ``length`` bytes.
                last = np.minimum(np.searchsorted(places, want + scheme.length - scheme.symbol) + 1, len(places))
                used = np.zeros(len(places) + 1, np.int64)
                np.add.at(used, first, 1)
                np.add.at(used, last, -1)
                on = np.flatnonzero(np.cumsum(used)[:-1] > 0)
                new = np.concatenate([[True], np.diff(on) != 1])
                head = on[np.flatnonzero(new)[np.cumsum(new) - 1]]
                t = places[on]
                e = np.minimum(t + scheme.symbol, len(data))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dn] * len(on), pa.int64()), pa.array(places[head]), pa.array(on - head),
                     pa.array(t), pa.array(e),
                     pa.array([data[a:z] for a, z in zip(t.tolist(), e.tolist(), strict=True)], pa.binary())],
                    ["dn", "s", "j", "t", "e", "prefix"])

    return texts.select("dn", "text", "wanted").mapInArrow(
        _joined(run, 20_000), "dn long, s long, j long, t long, e long, prefix binary")


def _by_hash(lookup: DataFrame) -> DataFrame:
    """The lookup side of a join, each key once in it: looked up by hash, so that neither side is sorted."""
    return lookup.hint("shuffle_hash")


def _named(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """``rows`` with ``sym``, the rank (from 1) of their values of ``by`` among the distinct ones, instead of these."""
    names, _ = numbered(rows.select(*by).distinct(), by, "names")
    names = names.select(*by, (F.col("rank") + 1).alias("sym"))
    return stored(rows.join(_by_hash(names), by).drop(*by), name)


def _counted(rows: DataFrame, order: list[str], name: str, used: list[DataFrame]) -> DataFrame:
    """``rows`` sorted by ``order``, with the number of rows of class 0 and of class 1 before each (``n0``, ``n1``)."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, ones, seen = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            cls = np.asarray(b.column("cls").to_numpy(zero_copy_only=False), dtype=np.int64)
            before = ones + np.cumsum(cls) - cls
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in ("dn", "s", "j", "cls")], pa.array(seen + np.arange(len(cls)) - before),
                 pa.array(before), pa.array(np.full(len(cls), part, np.int32))],
                ["dn", "s", "j", "cls", "n0", "n1", "part"])
            ones += int(cls.sum())
            seen += len(cls)

    placed = stored(rows.orderBy(*order).mapInArrow(
        run, "dn long, s long, j long, cls int, n0 long, n1 long, part int"), name)
    used.append(placed)
    sums = placed.groupBy("part").agg(F.sum((F.col("cls") == 0).cast("long")).alias("a"),
                                      F.sum("cls").alias("b")).collect()  # one row per partition
    starts, a, b = [], 0, 0
    for r in sorted(sums):
        starts.append((r["part"], a, b))
        a, b = a + r["a"], b + r["b"]
    before = rows.sparkSession.createDataFrame(starts, "part int, a long, b long")
    return (placed.join(F.broadcast(before), "part")
            .select("dn", "s", "j", "cls", (F.col("n0") + F.col("a")).alias("n0"), (F.col("n1") + F.col("b")).alias("n1")))


def _undecided(named: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """The stretches of names that the recursion has to order, (seg, jj, dn, s, j, sym, t, e), and a table behind them.

    A name met once, or one that reaches ``depth``, is decided: what follows it
    does not matter. Of each string stay the undecided names and the name after
    each of them; every stretch of these is a string of its own.
    """
    rows = named.select(
        "dn", "s", "j", (2 * F.col("s") + F.col("j") % 3 - 1).alias("s2"), F.expr("j div 3").alias("j2"),
        (F.col("name") + 1).alias("name"), "t", "e",
        ((F.col("n") > 1) & (F.col("e") - F.col("t") < depth) & (F.col("sym2") != 0)).alias("open"))
    at = Window.partitionBy("dn", "s2").orderBy("j2")
    kept = stored(rows.withColumn("after", F.coalesce(F.lag("open").over(at), F.lit(False)))
                  .where("open OR after").withColumn("id", F.monotonically_increasing_id()), "undecided")
    begins = F.coalesce(F.lag("j2").over(at) != F.col("j2") - 1, F.lit(True)) | (~F.lag("open").over(at))
    cut = kept.withColumn("seg", F.when(begins, F.col("id"))).withColumn("first", F.when(begins, F.col("j2")))
    upto = at.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return stored(cut.select("dn", "s", "j", F.last("seg", True).over(upto).alias("seg"),
                             (F.col("j2") - F.last("first", True).over(upto)).alias("jj"), F.col("name").alias("sym"), "t", "e"),
                  "stretches"), kept


def suffix_ranks(string: DataFrame, depth: int, used: list[DataFrame] | None = None) -> DataFrame:
    """(dn, s, j, rank): the order of all suffixes of the strings (dn, s), by the difference-cover algorithm.

    ``string`` has the columns dn, s, j (places from 0), sym (1 or more), t and e:
    the symbol stands for the bytes ``t`` to ``e``. Suffixes equal in ``depth``
    bytes may come in any order; others in that of their symbols, the end of a
    string first. The recursion takes only names that are not decided, until all
    are. ``used`` receives the written tables behind the result.
    """
    used = [] if used is None else used
    at = Window.partitionBy("dn", "s").orderBy("j")
    wide = stored(string.select(
        "dn", "s", "j", "t", "sym", F.coalesce(F.lead("sym", 1).over(at), F.lit(0)).alias("sym1"),
        F.coalesce(F.lead("sym", 2).over(at), F.lit(0)).alias("sym2"),
        F.greatest("e", F.lead("e", 1).over(at), F.lead("e", 2).over(at)).alias("e")), "triples")
    mod = F.col("j") % 3
    triple = ["sym", "sym1", "sym2"]
    sampled = wide.where(mod != 0).select("dn", "s", "j", "t", "e", *triple)
    met = stored(sampled.groupBy(*triple).agg(F.count(F.lit(1)).alias("n"), F.min(F.col("e") - F.col("t")).alias("least")), "names")
    short = met.where((F.col("n") > 1) & (F.col("least") < depth) & (F.col("sym2") != 0))
    if short.isEmpty():
        ranks, _ = numbered(sampled.select("dn", "s", "j", *triple), [*triple, "dn", "s", "j"], "sample_order")
        ranks = stored(ranks.select("dn", "s", "j", "rank"), "sample_ranks")
        discard(met)
    else:
        names, _ = numbered(met.select(*triple, "n"), triple, "name_order")
        named = stored(sampled.join(_by_hash(names), triple).select(
            "dn", "s", "j", "t", "e", "sym2", "n", F.col("rank").alias("name")), "named")
        stretches, kept = _undecided(named, depth)
        deeper: list[DataFrame] = []
        again = stretches.select(F.col("seg").alias("dn"), F.lit(0).cast("long").alias("s"), F.col("jj").alias("j"), "sym", "t", "e")
        below = suffix_ranks(again, depth, deeper).select(F.col("dn").alias("seg"), F.col("j").alias("jj"), F.col("rank").alias("sub"))
        inner = stored(stretches.join(_by_hash(below), ["seg", "jj"]).select("dn", "s", "j", "sub"), "inner_ranks")
        discard(*deeper)
        # Names first, and among equal ones the order that the recursion found.
        whole = (named.select("dn", "s", "j", "name").join(_by_hash(inner), ["dn", "s", "j"], "left").withColumn("sub", F.coalesce("sub", F.lit(-1))))
        ranks, _ = numbered(whole, ["name", "sub", "dn", "s", "j"], "sample_order")
        ranks = stored(ranks.select("dn", "s", "j", "rank"), "sample_ranks")
        discard(met, named, stretches, kept, inner)
    # The remaining suffixes come from their first symbol and the rank of the next place.
    known = wide.select("dn", "s", "j", "sym", "sym1").join(_by_hash(ranks), ["dn", "s", "j"], "left")
    full = stored(known.select("*", F.coalesce(F.lead("rank", 1).over(at), F.lit(-1)).alias("r1"),
                               F.coalesce(F.lead("rank", 2).over(at), F.lit(-1)).alias("r2")), "ranked")
    rest, one, two = (full.where(mod == k) for k in range(3))
    # Against places 1: symbol, then rank. Against places 2: two symbols, then rank. Ties: the sampled one first.
    cls = [F.lit(0).alias("cls"), F.lit(1).alias("cls")]
    by_one = (rest.select("dn", "s", "j", "sym", "r1", cls[0]).union(one.select("dn", "s", "j", "sym", "r1", cls[1]))
              .withColumn("tie", -F.col("cls")))
    by_two = (rest.select("dn", "s", "j", "sym", "sym1", "r2", cls[0])
              .union(two.select("dn", "s", "j", "sym", "sym1", "r2", cls[1])).withColumn("tie", -F.col("cls")))
    tables: list[DataFrame] = []
    a = _counted(by_one, ["sym", "r1", "tie", "dn", "s", "j"], "merge_one", tables)
    b = _counted(by_two, ["sym", "sym1", "r2", "tie", "dn", "s", "j"], "merge_two", tables)
    key = ["dn", "s", "j"]
    low = (a.where("cls = 0").select(*key, (F.col("n0") + F.col("n1")).alias("x"))
           .join(_by_hash(b.where("cls = 0").select(*key, F.col("n1").alias("y"))), key)
           .select(*key, (F.col("x") + F.col("y")).alias("rank")))
    up = (a.where("cls = 1").select(*key, "n0").union(b.where("cls = 1").select(*key, "n0")).join(_by_hash(ranks), key)
          .select(*key, (F.col("n0") + F.col("rank")).alias("rank")))
    used += [wide, ranks, full, *tables]
    return low.union(up)


def _repeated_windows(texts: DataFrame, ranks: DataFrame, scheme: Scheme) -> DataFrame:
    """(dn, i): window starts of wanted anchors whose ``length`` bytes start twice or more.

    Each place of a window start sorts by the bytes up to its anchor (and a few
    after it, which spreads the groups), then by the anchor's rank; neighbours
    compare the digests of their ``length`` bytes.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa

        parser = Parser(scheme)

        def found():
            for b in batches:
                rows = zip(b.column("dn").to_pylist(), b.column("text"), _lists(np, b.column("wanted")), _lists(np, b.column("ranks")), strict=True)
                for dn, text, wanted, ranked in rows:
                    order = np.argsort(ranked["t"])
                    t, lo, hi = (wanted[c].astype(np.int64) for c in ("t", "lo", "hi"))
                    rank = ranked["rank"][order][np.searchsorted(ranked["t"][order], t)]
                    for group, place, digest, i in parser.windows(text.as_py(), t, lo, hi, rank):
                        yield group, place, digest, np.full(len(i), dn), i.astype(np.int32)

        for group, rank, digest, dn, i in _together(np, found()):
            yield pa.RecordBatch.from_arrays([_long(np, group), pa.array(rank), _long(np, digest), pa.array(dn), pa.array(i)],
                                             ["g", "rank", "digest", "dn", "i"])

    listed = ranks.groupBy("dn").agg(F.collect_list(F.struct("t", "rank")).alias("ranks"))
    rows = texts.join(listed, "dn").mapInArrow(run, "g long, rank long, digest long, dn long, i int")
    return _equal_neighbours(rows.orderBy("g", "rank", "digest"))


def _equal_neighbours(ordered: DataFrame) -> DataFrame:
    """(dn, i) of the sorted rows that equal the row before or after them in ``g`` and ``digest``.

    Every sorted partition compares its own rows and gives out its first and its
    last one; these borders, two rows a partition, are compared afterwards.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, last, first = TaskContext.get().partitionId(), None, None
        names = ["g", "digest", "dn", "i", "border"]

        def given(rows, border):
            columns = list(zip(*rows, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32())
            return pa.RecordBatch.from_arrays([*[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                               pa.array([border] * len(rows), pa.int64())], names)

        for b in batches:
            if not b.num_rows:
                continue
            g, digest, dn, i = (b.column(c).to_numpy() for c in names[:4])
            same = (g[1:] == g[:-1]) & (digest[1:] == digest[:-1])
            hit = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            head = (int(g[0]), int(digest[0]), int(dn[0]), int(i[0]))
            if last is not None and last[:2] == head[:2]:
                hit[0] = True
                yield given([last], None)
            first = first or head
            last = (int(g[-1]), int(digest[-1]), int(dn[-1]), int(i[-1]))
            at = np.flatnonzero(hit)
            yield pa.RecordBatch.from_arrays([*[pa.array(x[at]) for x in (g, digest, dn, i)], pa.nulls(len(at), pa.int64())], names)
        if last is not None:
            yield given([first], 2 * part)
            yield given([last], 2 * part + 1)

    found = stored(ordered.select("g", "digest", "dn", "i").mapInArrow(run, "g long, digest long, dn long, i int, border long"), "neighbours")
    borders = sorted((r for r in found.where("border IS NOT NULL").collect()), key=lambda r: r["border"])   # two rows a partition
    met = []
    for x, y in zip(borders, borders[1:], strict=False):
        if x["border"] // 2 != y["border"] // 2 and (x["g"], x["digest"]) == (y["g"], y["digest"]):
            met += [(x["dn"], x["i"]), (y["dn"], y["i"])]
    more = ordered.sparkSession.createDataFrame(met, "dn long, i int")
    return found.where("border IS NULL").select("dn", "i").union(more)


def repeated_ranges(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(k1, k2, first, last): the window starts, from first to last, of each text that repeat."""
    scheme = Scheme(length)
    anchors = stored(find_anchors(docs, scheme), "anchors")
    # Written, so that the join stands alone and can be split at a hot passage.
    twice = stored(anchors.groupBy("f").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("f"), "repeated")
    held = stored(anchors.join(_by_hash(twice), "f", "left_semi"), "repeated_anchors")
    discard(anchors, twice)
    row = [*KEY, "t", "lo", "hi", "f"]
    # All of a class's firsts come from one row.
    classes = stored(held.groupBy("x1", "x2").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in row]),
                     "anchor_classes")
    whole = held.join(_by_hash(classes.where("n > 1").select("x1", "x2")), ["x1", "x2"], "left_semi").select(*KEY, "lo", "hi")
    edges = classes.where("n = 1").select(*row)
    mates = classes.where("n > 1").select(*row).join(_by_hash(edges.select("f").distinct()), "f", "left_semi").select(*row)
    wanted = stored(edges.union(mates).groupBy(*KEY).agg(
        F.sort_array(F.collect_list(F.struct("t", "lo", "hi"))).alias("wanted")), "wanted")
    met = lookup_join(_keyed(docs), wanted, KEY, "inner", materialized=True).dropDuplicates(KEY)
    texts = stored(met.select(*KEY, "text", "wanted", F.monotonically_increasing_id().alias("dn")), "edge_texts")
    rows = stored(_symbols(texts, scheme), "symbols")
    symbols = _named(rows, ["prefix"], "symbol_string")
    discard(rows)
    used: list[DataFrame] = []
    ranks = suffix_ranks(symbols, scheme.length, used).join(_by_hash(symbols.select("dn", "s", "j", "t")), ["dn", "s", "j"])
    anchor_ranks = stored(ranks.select("dn", "t", "rank"), "anchor_ranks")
    discard(*used, symbols)
    windows = _repeated_windows(texts, anchor_ranks, scheme)
    parts = windows.join(_by_hash(texts.select("dn", *KEY)), "dn").select(*KEY, F.col("i").alias("lo"), F.col("i").alias("hi"))
    run = F.shiftleft(F.col("lo").cast("long"), 32) + F.col("hi")
    ranges = whole.union(parts).groupBy(*KEY).agg(F.collect_list(run).alias("ranges"))
    out = stored(ranges.mapInArrow(_merge, "k1 long, k2 long, first array<int>, last array<int>"), "ranges")
    discard(held, classes, wanted, texts)
    return out


def _merge(batches):
    """Overlapping and touching ranges of a text, each packed as first * 2**32 + last, put together."""
    import numpy as np
    import pyarrow as pa

    for b in batches:
        column = b.column("ranges")
        offsets, packed = column.offsets.to_numpy(), column.values.to_numpy()
        firsts, lasts, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [0]
        for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            runs = np.sort(packed[a:z])
            lo, hi = runs >> 32, np.maximum.accumulate(runs & 0xFFFFFFFF)
            new = np.flatnonzero(lo[1:] > hi[:-1] + 1)
            firsts.append(lo[np.append(0, new + 1)].astype(np.int32))
            lasts.append(hi[np.append(new, len(hi) - 1)].astype(np.int32))
            sizes.append(len(new) + 1)
        ends = pa.array(np.cumsum(sizes).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [b.column("k1"), b.column("k2"), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(firsts))),
             pa.ListArray.from_arrays(ends, pa.array(np.concatenate(lasts)))], [*KEY, "first", "last"])


def cut_ranges(data: bytes, first: list[int], last: list[int], length: int) -> tuple[bytes, int]:
    """What is left without the bytes that windows starting in the ranges cover, and the number of removed runs."""
    left, at, spans = [], 0, 0
    for a, z in zip(first or [], last or [], strict=True):
        if a > at or not spans:
            spans += 1
        left.append(data[at:a] if a > at else b"")
        at = z + length
    left.append(data[at:])
    return b"".join(left), spans


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for every row of ``docs``.

    ``kept`` is the binary rest of the text. A null text counts as empty;
    repeated rows are documents of their own and repeat each other; texts below
    ``length`` bytes lose nothing; an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    ranges = repeated_ranges(docs, length)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = []
            for doc, data, first, last in zip(*[b.column(c).to_pylist() for c in ("doc_id", "text", "first", "last")],
                                              strict=True):
                left, spans = cut_ranges(data, first, last, length)
                rows.append((doc, len(data), len(data) - len(left), spans, hashlib.sha256(left).hexdigest(), left))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return lookup_join(_keyed(docs, "doc_id"), ranges, KEY, "left", materialized=True).select("doc_id", "text", "first", "last").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
