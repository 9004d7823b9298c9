"""N-gram Jaccard join with PartEnum signatures (operator 2).

A document is its set of distinct word shingles (64-bit hashes).  Sets of one
band of sizes that reach similarity ``num/den`` differ in at most
``k = floor((den-num) * 2u / (den+num))`` elements, ``u`` being the band's
largest size.  The element domain is hashed into ``n1`` first-level
partitions, each cut into ``n2`` second-level ones, with
``n1 * (k2 + 1) > k``: some first-level partition then holds at most ``k2``
differences, so one of its subsets of ``n2 - k2`` second-level partitions is
the same in both sets.  Every such subset is a signature, hence no linked pair
is missed.  A set also emits the signatures of the bands its larger partners
may lie in.  Signatures of few elements (or none) are met by sets that have
nothing else in common; as a set's own size leaves it more first-level
partitions that agree than one, it omits the lightest ones: so many partitions
hold no lighter subset that one of them agrees, and an equal subset weighs the
same in both sets.

Equal sets (by a 128-bit name) are collapsed to one node first.  Nearly all
signatures are met once: tasks first hand on short fingerprints of theirs, and
only signatures whose fingerprint is met again are joined at all.  Inside a signature's group not all
pairs are formed: every member is compared with one leader, components are
merged, and later rounds take other leaders for the groups that still span
several components.  What is still open then is compared pair by pair, so the
components are exact.  A pair's sets are met only if their parity sketches (one
bit per hashed place, set where an odd number of elements falls) allow a link:
the bits that differ never exceed the elements that differ.  Then the common
elements are counted exactly.

Edge cases: a null or empty text, or one without words, has the empty set and
links with nothing; with fewer words than a shingle the whole sequence is the
one shingle; rows that share an id are one node; a null id links with nothing
and has a null component; a very long text is one set, signed whole in one
task; of ids in one component the smallest names it; columns other than id and
text are not read, whatever their names; an empty table gives an empty
result."""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitlab.llm.common import BROADCAST_ROWS, connected_components, distinct_pairs, lists, map_batches, small, written
from traitlab.llm.text import mix, shingle_set
from traitlab.operators.sample import collect_bounded

_U = np.uint64
#: longs in a parity sketch (a power of two)
SKETCH = 16
#: bytes of all sketches up to which they are broadcast
SKETCH_BYTES = 32 << 20
#: different sets that may share a 64-bit name (some are expected from 10^10 sets on)
MAX_CLASHES = 10_000


class Bands:
    """Size bands: band i holds the sizes lo..hi with hi = floor(lo * ratio)."""

    def __init__(self, ratio: float = 1.5):
        self.ratio, self.hi = ratio, [1]

    def of(self, size: int) -> int:
        while self.hi[-1] < size:
            lo = self.hi[-1] + 1
            self.hi.append(max(lo, int(lo * self.ratio)))
        return int(np.searchsorted(self.hi, size))


def signatures(shingles: np.ndarray, num: int, den: int, n2: int, k2: int, bands: Bands) -> np.ndarray:
    """The PartEnum signatures of one set (sorted distinct hashes)."""
    size, out = len(shingles), []
    if not size:
        return shingles
    subsets = list(combinations(range(n2), n2 - k2))
    for band in range(bands.of(size), bands.of(size * den // num) + 1):
        k = (den - num) * 2 * bands.hi[band] // (den + num)
        if not k:  # linked sets of this band are equal, and one node already
            continue
        n1 = -(-(k + 1) // (k2 + 1))
        most = (den - num) * (size + min(bands.hi[band], size * den // num)) // (den + num)
        agree = n1 - most // (k2 + 1)  # first-level partitions that agree with any partner in this band, at least
        with np.errstate(over="ignore"):
            seeded = mix(shingles + _U((band + 1) * 0x9E3779B97F4A7C15 % 2**64))
            part = ((seeded >> _U(20)) % _U(n1 * n2)).astype(np.int64)
            sums = np.zeros(n1 * n2, dtype=np.uint64)
            np.add.at(sums, part, mix(seeded))
            sums = sums.reshape(n1, n2)
            held = np.bincount(part, minlength=n1 * n2).reshape(n1, n2)
            weigh = np.stack([held[:, subset].sum(axis=1) for subset in subsets])
            least = np.partition(weigh.min(axis=0), agree - 1)[agree - 1]  # fewer than ``agree`` partitions have a lighter subset
            first = np.arange(n1, dtype=np.uint64)
            for j, subset in enumerate(subsets):
                salt = (first * _U(len(subsets)) + _U(j)) * _U(4096) + _U(band)
                out.append(mix(sums[:, subset].sum(axis=1, dtype=np.uint64) ^ mix(salt))[weigh[j] >= least])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def set_name(shingles: np.ndarray) -> int:
    """64-bit fingerprint of a set, as a signed number."""
    with np.errstate(over="ignore"):
        return int(mix(np.array([mix(shingles).sum(dtype=np.uint64) + _U(len(shingles))])).view(np.int64)[0])


def check_name(shingles: np.ndarray) -> int:
    """A second fingerprint: with ``set_name`` 128 bits."""
    return set_name(shingles ^ _U(0xA5A5A5A5A5A5A5A5))


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(id, n, name, check) and the set's sketches (w, _0, _1 and so on) per
    row; null names for the empty set."""

    def work(batches):
        for cols in batches:
            sets = [shingle_set(t, shingle) for t in cols["t"]]
            name = [set_name(s) if len(s) else None for s in sets]
            check = [check_name(s) if len(s) else None for s in sets]
            sketch = np.array([parity_sketch(s) for s in sets]).reshape(-1, SKETCH)
            yield {"id": cols["id"], "n": [len(s) for s in sets], "name": name, "check": check, "w": lists([wide_sketch(s) for s in sets])} | {f"_{i}": sketch[:, i] for i in range(SKETCH)}

    return map_batches(docs, work, "id long, n long, name long, check long, w array<long>, " + ", ".join(f"_{i} long" for i in range(SKETCH)))


def node_of(shingles: np.ndarray, clashes: frozenset) -> int:
    """The number of a set: its name, or its check where sets share a name."""
    name = set_name(shingles)
    return check_name(shingles) if name in clashes else name


class Signing:
    """Walks batches of texts; a task signs each set it meets once."""

    def __init__(self, shingle: int, num: int, den: int, n2: int, k2: int, clashes: frozenset):
        self.shingle, self.rule, self.clashes = shingle, (num, den, n2, k2), clashes

    def rows(self, batches):
        """Lists of (node, signatures), a list per batch."""
        bands, seen = Bands(), set()
        for cols in batches:
            out = []
            for text in cols["t"]:
                s = shingle_set(text, self.shingle)
                if not len(s) or (node := node_of(s, self.clashes)) in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(node)
                out.append((node, np.unique(signatures(s, *self.rule, bands))))
            yield out


def _repeated(texts: DataFrame, signing: Signing, bits: int, held: int = 1 << 20) -> DataFrame:
    """(fp): the leading ``32 + bits`` bits of every signature that tasks met
    more than once, and of few others.  A task hands on its signatures as
    sorted 32-bit numbers cut into ``2 ** bits`` slices, a number at most twice
    per ``held`` signatures, so that a signature of many sets weighs little;
    a slice is counted exactly."""

    def work(batches):
        have, n = [], 0

        def cut():
            every = np.sort(np.concatenate(have)) >> _U(32 - bits)
            again = np.unique(every[1:][every[1:] == every[:-1]])
            every = np.sort(np.concatenate([np.unique(every), again]))
            ends = np.searchsorted(every, np.arange(1 << bits, dtype=np.uint64) << _U(32)).tolist() + [len(every)]
            full = [i for i in range(1 << bits) if ends[i] < ends[i + 1]]
            return {"slice": full, "fps": [every[ends[i] : ends[i + 1]].astype("<u4").tobytes() for i in full]}

        for rows in signing.rows(batches):
            for _, sigs in rows:
                have.append(sigs)
                n += len(sigs)
                if n >= held:
                    yield cut()
                    have, n = [], 0
        if n:
            yield cut()

    def count(key, table):
        import pyarrow as pa

        fps = np.sort(np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in table.column("fps")]))
        again = np.unique(fps[1:][fps[1:] == fps[:-1]]).astype(np.int64)
        return pa.table({"fp": pa.array(again + (key[0].as_py() << 32), pa.int64())})

    return map_batches(texts, work, "slice long, fps binary").groupBy("slice").applyInArrow(count, "fp long")


def _members(texts: DataFrame, signing: Signing, shingles: int, once: bool) -> DataFrame:
    """(sig, node) of the signatures that two or more nodes share.  Signatures
    met once (nearly all) are left out before anything is joined; slices follow
    the number of shingles, about one signature or less for each.  Rows move
    to drop repeats only if not every node is signed ``once``."""
    bits = min(31, max(6, (shingles // 8_000_000).bit_length()))
    repeated = written(_repeated(texts, signing, bits), "repeated")

    def work(batches):
        for rows in signing.rows(batches):
            yield {"node": [x for x, _ in rows], "sigs": lists([s for _, s in rows])}

    rows = map_batches(texts, work, "node long, sigs array<long>").select(F.explode("sigs").alias("sig"), "node")
    rows = written(rows.join(small(repeated, 10 * BROADCAST_ROWS), F.shiftrightunsigned("sig", 32 - bits) == F.col("fp"), "left_semi"), "signed")
    shared = written(rows.groupBy("sig").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x != y").select("sig"), "shared")
    rows = rows.join(small(shared, 10 * BROADCAST_ROWS), "sig", "left_semi")
    return rows if once else rows.dropDuplicates(["sig", "node"])


def parity_sketch(shingles: np.ndarray, longs: int = SKETCH) -> np.ndarray:
    """``longs`` longs (a power of two); bit j is the parity of the elements
    hashed to place j.  Halves of a sketch, XORed, are the next smaller one."""
    with np.errstate(over="ignore"):
        place = mix(shingles ^ _U(0x94D049BB133111EB)) & _U(64 * longs - 1)
    odd = (np.bincount(place.astype(np.int64), minlength=64 * longs) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def wide_sketch(shingles: np.ndarray) -> np.ndarray:
    """For sets too large for SKETCH longs: about a bit per element."""
    longs = 1 << max(0, int(len(shingles) // 64).bit_length())
    return parity_sketch(shingles, longs) if longs > SKETCH else np.empty(0, np.int64)


def _differ(x: str, y: str) -> Column:
    """Bits in which the sketches of sides ``x`` and ``y`` differ."""
    return sum((F.bit_count(F.col(f"{x}{i}").bitwiseXOR(F.col(f"{y}{i}"))) for i in range(SKETCH)), F.lit(0))


def _differ_wide(x: Column, y: Column) -> Column:
    """The same of wide sketches, the longer one folded (0 without both)."""
    half = lambda v: F.zip_with(F.slice(v, 1, (F.size(v) / 2).cast("int")), F.slice(v, (F.size(v) / 2).cast("int") + 1, F.size(v)), lambda p, q: p.bitwiseXOR(q))
    bits = lambda v, w: F.aggregate(F.zip_with(v, w, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, b: s + b)
    one, two = F.size(x), F.size(y)
    return F.when((one == 0) | (two == 0), 0).when(one == two, bits(x, y)).when(one == 2 * two, bits(half(x), y)).when(two == 2 * one, bits(x, half(y))).otherwise(0)


def _may_link(num: int, den: int) -> Column:
    """Sizes and sketches of sides x and y allow similarity num/den."""
    sizes = (F.least("xn", "yn") * den) >= F.greatest("xn", "yn") * num
    most = (F.col("xn") + F.col("yn")) * (den - num)
    return sizes & (_differ("x", "y") * (den + num) <= most) & (_differ_wide(F.col("xw"), F.col("yw")) * (den + num) <= most)


def _verified(pairs: DataFrame, sets_of, num: int, den: int) -> DataFrame:
    """Of ``pairs(a, b)``, a written table, those whose sets reach num/den.
    Only the sets of their nodes are read again, by ``sets_of``."""
    few, arrays = small(pairs), sets_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    left = arrays.select(F.col("node").alias("a"), F.col("s").alias("sa")).join(few, "a")
    right = arrays.select(F.col("node").alias("b"), F.col("s").alias("sb")).join(small(pairs.select("b").distinct(), 10 * BROADCAST_ROWS) if few is not pairs else pairs.select("b").distinct(), "b", "left_semi")
    both = left.join(right, "b").select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("i"))
    return both.where(F.col("i") * den >= (F.col("na") + F.col("nb") - F.col("i")) * num).select("a", "b")


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, num: int = 90, den: int = 100, n2: int = 3, k2: int = 1, leader_rounds: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id) per document; documents link when
    ``den * |A and B| >= num * |A or B|``."""
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    named = written(_sets(picked, shingle), "sets")
    clashes = frozenset(r[0] for r in collect_bounded(named.where("name is not null").groupBy("name").agg(F.min("check").alias("c1"), F.max("check").alias("c2")).where("c1 != c2").select("name"), MAX_CLASHES, "names of several sets"))
    number = F.when(F.col("name").isin(*clashes), F.col("check")).otherwise(F.col("name")) if clashes else F.col("name")
    sets = named.select("id", "n", number.alias("node"), "w", *[f"_{i}" for i in range(SKETCH)])
    reps = written(sets.where("node is not null and id is not null").groupBy("node").agg(F.min("id").alias("rep"), F.first("n").alias("n")), "reps")
    # ids of copies alone need no signing; where they are too many to broadcast they are signed too, to the same end
    copies = written(sets.where("node is not null and id is not null").select("id").distinct().join(reps.select(F.col("rep").alias("id")).distinct(), "id", "left_anti"), "copies")
    texts, signed = picked.where("id is not null"), sets.where("node is not null and id is not null").select("id")
    if copies.count() <= 10 * BROADCAST_ROWS:
        texts, signed = (x.join(F.broadcast(copies), "id", "left_anti") for x in (texts, signed))
    signing = Signing(shingle, num, den, n2, k2, clashes)
    members = written(_members(texts.select("t"), signing, reps.agg(F.sum("n")).first()[0] or 0, signed.count() == reps.count()), "members")
    links = _links(picked, sets, reps, members, signing, num, den, leader_rounds)
    if links is None:
        classes = reps.select("node", F.col("rep").alias("component_id"))
    else:
        named = reps.select("node", "rep")
        edges = links.join(named.select(F.col("node").alias("a"), F.col("rep").alias("ra")), "a").join(named.select(F.col("node").alias("b"), F.col("rep").alias("rb")), "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        roots = written(connected_components(edges), "roots")
        classes = written(named.join(small(roots), named["rep"] == roots["node"], "left").select(named["node"], F.coalesce("root", "rep").alias("component_id")), "classes")
    out = sets.select("id", "n", "node").join(small(classes), "node", "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))


def _links(picked: DataFrame, sets: DataFrame, reps: DataFrame, members: DataFrame, signing: Signing, num: int, den: int, leader_rounds: int) -> DataFrame | None:
    """Links between nodes that connect every component (null if none)."""
    rows = members.count()
    if not rows:
        return None
    nodes = written(members.select("node").distinct().join(reps, "node").select("node", F.col("rep").alias("id")), "nodes")
    # a node comes twice only if its id does
    again = not sets.groupBy("id").count().where("count > 1").join(nodes, "id", "left_semi").isEmpty()
    once = lambda df: df.dropDuplicates(["node"]) if again else df

    def arrays(batches):
        for cols in batches:
            named = [(x, shingle_set(t, signing.shingle)) for x, t in zip(cols["node"], cols["t"])]
            named = [(x, s) for x, s in named if len(s) and node_of(s, signing.clashes) == x]  # rows may share an id
            yield {"node": [x for x, _ in named], "s": lists([s for _, s in named])}

    def sets_of(some):
        """(node, s) of ``some`` nodes; their texts move only if the nodes are too many to broadcast."""
        wanted = written(nodes.join(some, "node", "left_semi"), "wanted")
        texts = picked.join(small(wanted, 10 * BROADCAST_ROWS), "id").select("node", "t")
        return written(once(map_batches(texts, arrays, "node long, s array<long>")), "arrays")

    whole = written(once(sets.join(small(nodes), ["node", "id"], "left_semi").drop("id")), "sketches")
    n, longs = whole.agg(F.count("*"), F.sum(F.size("w"))).first()
    wide_rows = n if 8 * (n * (SKETCH + 4) + (longs or 0)) <= SKETCH_BYTES else 0  # broadcast by bytes
    info = lambda side: whole.select(F.col("node").alias(side), F.col("n").alias(f"{side}n"), F.col("w").alias(f"{side}w"), *[F.col(f"_{i}").alias(f"{side}{i}") for i in range(SKETCH)])
    links, before = None, None
    for turn in range(leader_rounds + 1):
        if turn:
            comp = written(connected_components(links), "comp")
            at = members.join(small(comp), "node", "left").select("sig", "node", F.coalesce("root", "node").alias("root"))
            spread = at.groupBy("sig", "root").agg(F.count("*").alias("k")).groupBy("sig").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("own"), F.count("*").alias("roots"))
            spread = written(spread.where("roots > 1"), "open")
            rows, cross = spread.agg(F.sum("k"), F.sum((F.col("k") * F.col("k") - F.col("own")) / 2)).first()
            if not rows:
                return links
            members = written(members.join(small(spread.select("sig"), 10 * BROADCAST_ROWS), "sig", "left_semi"), "open-members")
            at = members.join(small(comp), "node", "left").select("sig", "node", F.coalesce("root", "node").alias("root"))
        else:
            at, cross = members.withColumn("root", F.col("node")), float("inf")
        last = turn == leader_rounds or cross <= 20 * rows or (turn > 1 and cross > 0.8 * before)
        before = cross
        if last and cross > 20 * rows:  # too many pairs to be moved before their sketches are compared
            x = at.select("sig", F.col("node").alias("x"), F.col("root").alias("xr")).join(small(info("x"), wide_rows), "x")
            y = at.select("sig", F.col("node").alias("y"), F.col("root").alias("yr")).join(small(info("y"), wide_rows), "y")
            pairs = x.join(y, "sig").where("x < y and xr != yr").where(_may_link(num, den)).select("x", "y").distinct()
        else:
            if last:  # a pair meets in many signatures: its sketches are fetched once
                other = at.select("sig", F.col("node").alias("lead"), F.col("root").alias("lr"))
                met = at.join(other, "sig").where("node < lead and root != lr")
            elif turn:
                pick = F.min(F.struct(F.xxhash64("node", "sig", F.lit(turn)), F.col("node"), F.col("root")))
                lead = written(at.groupBy("sig").agg(pick.alias("l")).select("sig", F.col("l.node").alias("lead"), F.col("l.root").alias("lr")), "lead")
                met = at.join(small(lead), "sig").where("root != lr")
            else:  # every node is its own root
                pick = F.min(F.struct(F.xxhash64("node", F.lit(turn)), F.col("node")))
                lead = written(members.groupBy("sig").agg(pick.alias("l")).select("sig", F.col("l.node").alias("lead")), "lead")
                met = members.join(small(lead), "sig").where("node != lead")
            met = written(distinct_pairs(met.select("node", "lead"), "node", "lead"), "met")
            pairs = met.select(F.col("a").alias("x"), F.col("b").alias("y")).join(small(info("x"), wide_rows), "x").join(small(info("y"), wide_rows), "y").where(_may_link(num, den)).select("x", "y")
        pairs = written(pairs.select(F.col("x").alias("a"), F.col("y").alias("b")), "pairs")
        new = written(_verified(pairs, sets_of, num, den), "links")
        links = new if links is None else links.unionByName(new)
        if last:
            return links
    return links


def one_of_each(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is its group's smallest (rows that repeat
    an id stay together; rows without id stay)."""
    out = written(groups.where("doc_id != component_id").select(F.col("doc_id").alias("_drop")).distinct(), "drop")
    return docs.join(small(out, 10 * BROADCAST_ROWS), F.col(id_col) == F.col("_drop"), "left_anti")
