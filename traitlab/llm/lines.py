"""Line dedup by a fixed-depth log-template tree (operator 8); DataFrame
functions only.

A line's words with a digit become ``<*>``.  The tree's path is the number of
words, then the first ``depth`` of them; a leaf holds the lines of one path.
Two kinds of template are formed in a leaf: the masked line itself, and, where
a leaf has several, one generalised template: a position is fixed if one word
holds at least half of the leaf's different lines there, other positions are
variable, and the template stands if at least ``fixed`` of its positions are
fixed.  A template that recurs across unrelated documents is dropped, with all
its lines.

Copies of a document are not unrelated: equal texts count once, and texts
whose sets of three-word shingles are alike by ``alike`` or more form a family.
That is decided on the text as a whole: every text has a bottom-k sketch of its
shingles, the least sketch values of ``KEYS`` residues name the texts to compare
with, and a pair is linked only if its two sketches agree, so lines that
unrelated documents have in common make no family of them.  A template recurs
if it stands in one family and in at least ``min_docs`` others.  So copies keep
their text here and are left to the near-duplicate operators.

Every line with a word takes part, however short.  A line of numbers alone, of
at most ``NUMBERS`` words, counts as it stands: masked, it would equal any other.

Edge cases: null text stays null, with no lines; lines without a word are never
dropped; a document may lose all its lines and
then has the empty text; equal rows get equal results; an empty table gives an
empty result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitlab.llm.common import connected_components, parts_for, small, written

#: words of a shingle, values of a sketch, values that name texts to compare with
SHINGLE, SKETCH, KEYS = 3, 64, 16
#: so many words without a letter say nothing once masked
NUMBERS = 3
#: sketches that may be broadcast
SKETCH_ROWS = 50_000
_SPACE, _WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def _words(bare: Column) -> Column:
    """Words of trimmed text (none: one empty word).  A plain space is split
    without a regular expression, the usual case."""
    odd = [F.contains(bare, F.lit(x)) for x in ("  ", "\t", "\r", "\x0b", "\x0c")]
    return F.when(odd[0] | odd[1] | odd[2] | odd[3] | odd[4], F.split(bare, _SPACE + "+")).otherwise(F.split(bare, " "))


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\x0b\x0c"))


def _masked(words: Column) -> Column:
    return F.transform(words, lambda w: F.when(w.rlike("[0-9]"), "<*>").otherwise(w))


def _tokens(line: Column) -> Column:
    """Words of a line, those with a digit masked."""
    return _masked(_words(_bare(line)))


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _leaf(words: Column, depth: int) -> Column:
    return F.xxhash64(F.size(words), F.slice(words, 1, depth))


def _least(r: int) -> Column:
    """The least sketch value of residue ``r``."""
    return F.array_min(F.filter("values", lambda x: F.pmod(x, F.lit(KEYS)) == r))


def _outlines(rows: DataFrame, depth: int) -> DataFrame:
    """(row, key, text_hash, keys, sketch, lines) of every text, its words
    split once.  ``lines`` holds (i, leaf, n, template) of the lines with a
    word, ``keys`` the 64-bit values that name texts to compare with, ``sketch``
    the upper halves of the least shingle values, in their order."""
    lines = F.transform(_split(F.col("t")), _bare)
    cut = F.transform(lines, lambda b: F.struct(_words(b).alias("raw"), b.rlike("[0-9]").alias("digit")))
    both = F.transform(cut, lambda x: F.struct(x["raw"].alias("raw"), F.when(x["digit"], _masked(x["raw"])).otherwise(x["raw"]).alias("w")))
    texts = rows.where("t is not null").select("key", "text_hash", both.alias("x"))
    info = F.transform("x", lambda x, i: F.struct(i.alias("i"), _leaf(x["w"], depth).alias("leaf"), F.size(x["w"]).alias("n"), _template(x["raw"], x["w"]).alias("template"), (x["w"][0] != "").alias("any")))
    words = F.flatten(F.transform(F.filter("x", lambda x: x["raw"][0] != ""), lambda x: x["raw"]))
    texts = texts.select("key", "text_hash", F.filter(info, lambda y: y["any"]).alias("lines"), words.alias("words"))
    last = F.greatest(F.size("words") - (SHINGLE - 1), F.lit(1))
    shingles = F.slice(F.transform("words", lambda w, i: F.xxhash64(w, *[F.get("words", i + j) for j in range(1, SHINGLE)])), 1, last)
    texts = texts.select("key", "text_hash", "lines", shingles.alias("all"))
    # of a long text only the lower values are sorted, if they are enough
    low = (F.lit(-(2.0**63)) + F.lit(2.0**64 * 4 * SKETCH) / F.size("all")).cast("long")
    texts = texts.withColumn("low", F.when(F.size("all") > 4 * SKETCH, F.array_distinct(F.filter("all", lambda x: x < low))))
    values = F.slice(F.sort_array(F.when(F.size("low") >= SKETCH, F.col("low")).otherwise(F.array_distinct("all"))), 1, SKETCH)
    texts = texts.select("key", "text_hash", "lines", values.alias("values"))
    keys = F.array_compact(F.array(*[_least(r) for r in range(KEYS)]))
    sketch = F.array_distinct(F.transform("values", lambda x: F.shiftright(x, 32).cast("int")))
    return texts.select(F.monotonically_increasing_id().alias("row"), "key", "text_hash", keys.alias("keys"), sketch.alias("sketch"), "lines")


def _families(outlines: DataFrame, alike: float) -> DataFrame:
    """(text_hash, root) of every text that is a copy or edited copy of another
    one; texts without such are left out.  Texts that share a key are compared
    with the least text of that key alone, so no group's pairs are listed.  Of
    equal texts only the first row's sketch moves."""
    again = written(outlines.groupBy("text_hash").agg(F.min("row").alias("first"), F.count("*").alias("c")).where("c > 1").select("text_hash", "first"), "again")
    once = outlines.join(small(again), "text_hash", "left").where("first is null or first = row")
    keys = once.select("text_hash", F.explode("keys").alias("sig"))
    first = written(keys.groupBy("sig").agg(F.min("text_hash").alias("lead"), F.count("*").alias("c")).where("c > 1").select("sig", "lead"), "leads")
    pairs = written(keys.join(small(first), "sig").where("text_hash != lead").select("text_hash", "lead").distinct(), "pairs")
    sketches = once.select("text_hash", "sketch")
    leads = written(sketches.join(small(pairs.select(F.col("lead").alias("text_hash")).distinct()), "text_hash", "left_semi").select(F.col("text_hash").alias("lead"), F.col("sketch").alias("other")), "leads")
    both = pairs.join(sketches, "text_hash").join(small(leads, SKETCH_ROWS), "lead")
    both = both.withColumn("all", F.slice(F.sort_array(F.array_union("sketch", "other")), 1, SKETCH))
    same = F.size(F.array_intersect("all", F.array_intersect("sketch", "other")))
    return connected_components(both.where(same >= F.lit(alike) * F.size("all")).select(F.col("text_hash").alias("a"), F.col("lead").alias("b"))).select(F.col("node").alias("text_hash"), "root")


def _template(raw: Column, words: Column) -> Column:
    numbers = (F.size(words) <= NUMBERS) & (F.array_min(words) == "<*>") & (F.array_max(words) == "<*>")
    return F.when(numbers, F.xxhash64(raw)).otherwise(F.xxhash64(words))


def _recurring(uses: DataFrame, name: str, min_docs: int) -> DataFrame:
    """Of ``uses(name, family)`` the values of ``name`` that recur across
    unrelated texts.  Two partial aggregations; no group is held."""
    return uses.select(name, "family").distinct().groupBy(name).agg(F.count("*").alias("n")).where(F.col("n") > min_docs).select(name)


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 3, min_docs: int = 3, general_words: int = 6, fixed: float = 0.7, alike: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """(rows with ``key`` and ``t``, table (key, places) of dropped lines)."""
    text = F.col(text_col)
    rows = docs.withColumn("key", F.xxhash64(F.col(id_col), text)).withColumn("t", text).withColumn("text_hash", F.xxhash64(text))
    outlines = written(_outlines(rows.select("key", "text_hash", "t"), depth), "outlines")
    families = written(_families(outlines, alike), "families")
    flat = outlines.select("key", "text_hash", F.explode("lines").alias("x")).select("key", "text_hash", "x.i", "x.leaf", "x.n", "x.template").join(small(families), "text_hash", "left")
    flat = written(flat.select("key", "text_hash", "i", "leaf", "n", "template", F.coalesce("root", "text_hash").alias("family")), "lines")
    exact = _recurring(flat, "template", min_docs)
    general = _general(rows, flat, depth, min_docs, general_words, fixed)
    gone = written(exact.unionByName(general).distinct(), "templates")
    places = flat.join(small(gone), "template", "left_semi").groupBy("key").agg(F.collect_set("i").alias("places"))
    return rows, written(places, "places")


def _general(rows: DataFrame, flat: DataFrame, depth: int, min_docs: int, general_words: int, fixed: float) -> DataFrame:
    """Masked lines that match a generalised template that recurs."""
    # only leaves with several templates in more than min_docs texts can hold one
    kinds = flat.where(F.col("n") >= general_words).groupBy("leaf", "template").agg(F.min("text_hash").alias("x"), F.max("text_hash").alias("y"))
    leaves = kinds.groupBy("leaf").agg(F.count("*").alias("kinds"), F.sum(F.when(F.col("x") == F.col("y"), 1).otherwise(2)).alias("texts"))
    leaves = written(leaves.where((F.col("kinds") > 1) & (F.col("texts") > min_docs)).select("leaf"), "leaves")
    lines = flat.join(small(leaves), "leaf", "left_semi")
    # one line of each kind brings its words: the first by (key, place)
    where = written(lines.groupBy("leaf", "template").agg(F.min(F.struct("key", "i")).alias("at")).select("leaf", "template", "at.*"), "kinds")
    parts = parts_for(where.count(), 20_000)
    texts = rows.select("key", "t").join(small(written(where.groupBy("key").agg(F.collect_list(F.struct("leaf", "template", "i")).alias("at")), "at")), "key")
    words = texts.select(F.explode("at").alias("at"), _split(F.col("t")).alias("lines")).select("at.leaf", "at.template", _tokens(F.get("lines", F.col("at.i"))).alias("tokens"))
    words = written(words.dropDuplicates(["leaf", "template"]).coalesce(parts), "words").select("leaf", "template", F.size("tokens").alias("n"), F.posexplode("tokens").alias("p", "word"))
    count = words.groupBy("leaf", "n", "p", "word").agg(F.count("*").alias("k"))
    mode = count.groupBy("leaf", "n", "p").agg(F.max(F.struct("k", "word")).alias("m"), F.sum("k").alias("all"))
    kept = mode.where((F.col("m.k") * 2 >= F.col("all")) & (F.col("m.word") != "<*>")).select("leaf", "n", "p", F.col("m.word").alias("word"))
    kept = written(kept.coalesce(parts), "fixed")
    tree = written(kept.groupBy("leaf", "n").agg(F.count("*").alias("c")).where(F.col("c") >= F.lit(fixed) * F.col("n")).select("leaf", "c").coalesce(parts), "tree")
    agree = words.join(small(kept.select("leaf", "p", "word")), ["leaf", "p", "word"]).groupBy("leaf", "template").agg(F.count("*").alias("same"))
    matching = written(agree.join(small(tree), "leaf").where("same = c").select("leaf", "template").coalesce(parts), "matching")
    uses = lines.join(small(matching), ["leaf", "template"], "left_semi").select(F.col("leaf").alias("g"), "family")
    again = written(_recurring(uses, "g", min_docs).coalesce(parts), "general")
    return matching.join(small(again), matching["leaf"] == again["g"], "left_semi").select("template")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with ``text_col`` less the dropped lines, and two more columns,
    ``_n_lines`` and ``_n_dropped`` (both names are replaced if present)."""
    own = [c for c in docs.columns if c not in ("_n_lines", "_n_dropped")]
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)])
    names = {c: f"c{i}" for i, c in enumerate(own)}
    rows, places = dropped_lines(plain, names[id_col], names[text_col], **options)
    joined = rows.join(small(places), "key", "left")
    all_lines = _split(F.col("t"))
    keep = F.when(F.col("places").isNull(), F.col("t")).otherwise(F.array_join(F.filter(all_lines, lambda x, i: ~F.array_contains(F.col("places"), i)), "\n"))
    out = [keep.alias(c) if c == text_col else F.col(names[c]).alias(c) for c in own]
    n = F.when(F.col("t").isNull(), 0).otherwise(F.size(all_lines)).cast("long")
    return joined.select(*out, n.alias("_n_lines"), F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("_n_dropped"))
