"""Fuzzy line de-duplication in DataFrame expressions only.

Lines are normalised (letters and digits, lower case) and SimHashed over their words; equal ones are one row
from then on. Two fingerprints within ``radius`` bits agree in at least ``blocks - radius`` of ``blocks`` bit
blocks, so they meet in a bucket of that many blocks (pigeonhole). Lines that meet and are near enough are linked
when their edit similarity over words reaches ``similarity``; of each connected group the first occurrence stays.

The votes of the words are added up by one hash aggregation whose map side folds a line before anything is
shuffled. Fingerprints are compared, not lines: of the lines with one fingerprint a representative
stands for the others that are linked to it, and only lines which that leaves in different components are
paired. No link between lines of different components is left out.
"""

from __future__ import annotations

from itertools import combinations, count

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.components import connected_components
from millrace.session import stage_table

BITS = 63
BLOCKS = 5
RADIUS = 3
SIMILARITY = 0.8
BROADCAST_BYTES = 32 << 20
# Seven counters of nine bits side by side in one number; they hold the votes of 255 words.
LANE, SEGMENT_WORDS = 9, 255
STEP = 5  # words whose votes are added up before they are aggregated; divides SEGMENT_WORDS
ONES = sum(1 << at for at in range(0, BITS - LANE + 1, LANE))


def normalised_words(line: Column) -> Column:
    """The runs of letters and digits in lower case; joined by blanks they are the normalised line."""
    return F.array_remove(F.split(F.lower(line), r"[^\p{L}\p{N}]+"), "")


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body``."""
    return F.transform(F.array(value), body)[0]


def votes(*hashes: Column) -> list[Column]:
    """Sums over the word hashes of a row: counter ``j`` of sum ``k`` counts bit ``k + LANE * j``."""
    return [F.sum(sum((F.shiftrightunsigned(h, k).bitwiseAND(F.lit(ONES)) for h in hashes[1:]),
                      F.shiftrightunsigned(hashes[0], k).bitwiseAND(F.lit(ONES)))).alias(f"s{k}") for k in range(LANE)]


def majority(n: Column) -> Column:
    """Fingerprint from the sums ``s0 ..`` of fewer than ``SEGMENT_WORDS`` words: bits set in over half of n.

    Adding ``2 ** (LANE - 1) - 1 - n div 2`` to a counter sets its top bit exactly when it is over half of n.
    """
    lift, out = (F.lit((1 << (LANE - 1)) - 1).cast("long") - F.floor(n / 2)) * F.lit(ONES), None
    for k in range(LANE):
        bits = F.shiftleft(F.shiftrightunsigned(F.col(f"s{k}") + lift, LANE - 1).bitwiseAND(F.lit(ONES)), k)
        out = bits if out is None else out.bitwiseOR(bits)
    return out


def line_segments(docs: DataFrame) -> DataFrame:
    """Votes per ``SEGMENT_WORDS`` words of each line with content of ``docs(doc_id, text)``.

    doc_id, text_key, line_no (from 0), key (of the normalised line), segment, n and either fp, for a line of
    one segment, or the sums ``s0 ..``.
    """
    # The text is hashed below the generator, once and not for each of its lines.
    own = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").select(
        "doc_id", "text_key", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_no", "line"))
    # Behind a generator the words are computed once, however often they are read.
    normal = own.select("doc_id", "text_key", "line_no", F.explode(F.array(normalised_words(F.col("line")))).alias("words"))
    keyed = normal.where(F.size("words") > 0).select(
        "doc_id", "text_key", "line_no", F.unhex(F.md5(F.array_join("words", " "))).alias("key"), "words")
    # A row of the aggregation holds ``STEP`` words; a hash of 0 has no votes.
    steps = keyed.select("*", F.size("words").alias("size")).select("*", F.explode(F.sequence(
        F.lit(0), F.col("size") - 1, F.lit(STEP))).alias("at"))
    words = steps.select("doc_id", "text_key", "line_no", "key", "at", F.least(F.lit(STEP), F.col("size") - F.col("at")).alias("held"), *[
        F.when(F.col("at") + i < F.col("size"), F.xxhash64(F.get("words", F.col("at") + i))).otherwise(F.lit(0)).alias(f"h{i}")
        for i in range(STEP)])
    segment = F.expr(f"at div {SEGMENT_WORDS}").alias("segment")
    summed = words.groupBy("doc_id", "text_key", "line_no", "key", segment).agg(
        F.sum("held").alias("n"), *votes(*[F.col(f"h{i}") for i in range(STEP)]))
    alone = (F.col("segment") == 0) & (F.col("n") < SEGMENT_WORDS)
    return summed.select("doc_id", "text_key", "line_no", "key", "segment", "n", F.when(alone, majority(F.col("n")))
                         .alias("fp"), *[F.when(~alone, F.col(f"s{k}")).alias(f"s{k}") for k in range(LANE)])


def fingerprinted(segments: DataFrame) -> DataFrame:
    """doc_id, text_key, line_no, key, n (words) and fp of each line."""
    place = ["doc_id", "text_key", "line_no", "key"]
    long = segments.where(F.col("fp").isNull()).groupBy(*place).agg(F.sum("n").alias("n"), *[
        F.sum(F.shiftrightunsigned(f"s{b % LANE}", b // LANE * LANE).bitwiseAND(F.lit((1 << LANE) - 1))).alias(f"b{b}")
        for b in range(BITS)])
    bits = [F.when(F.col(f"b{b}") * 2 > F.col("n"), F.lit(1 << b)).otherwise(F.lit(0)) for b in range(BITS)]
    joined = bits[0].cast("long")
    for b in bits[1:]:
        joined = joined.bitwiseOR(b)
    return segments.where(F.col("fp").isNotNull()).select(*place, "n", "fp").union(
        long.select(*place, "n", joined.alias("fp")))


def masks(radius: int, blocks: int) -> list[int]:
    """The bits of each choice of ``blocks - radius`` blocks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    return [sum((1 << edges[b + 1]) - (1 << edges[b]) for b in chosen)
            for chosen in combinations(range(blocks), blocks - radius)]


def most_edits(words: Column | int, similarity: float):
    """Edits that leave two lines of at most ``words`` words similar enough."""
    allowed = words * (1 - similarity) + 1e-9
    return int(allowed) if isinstance(words, int) else F.floor(allowed).cast("int")


def near_fingerprints(fps: DataFrame, radius: int, blocks: int, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs ``x < y`` of ``fps(fp, shortest, longest)`` within ``radius`` bits, each once.

    Pairs whose word counts (between ``shortest`` and ``longest``) differ too much for ``similarity`` are left out.
    """
    chosen = masks(radius, blocks)
    # Choice and 32 bits of a hash in one small number, which sorts by radix in few passes, and both word counts in
    # another (a text has fewer than 2 ** 31 words). The exact test of the bits follows.
    low = (1 << 32) - 1
    spread = fps.select("fp", F.shiftleft(F.col("longest").cast("long"), 32).bitwiseOR(F.col("shortest")).alias("sizes"), F.explode(
        F.array(*[F.xxhash64(F.col("fp").bitwiseAND(F.lit(m))).bitwiseAND(F.lit(low)).bitwiseOR(F.lit(i << 32))
                  for i, m in enumerate(chosen)])).alias("bucket"))
    x, y = spread.alias("x"), spread.alias("y")
    apart, choice = F.col("x.fp").bitwiseXOR(F.col("y.fp")), F.shiftright("x.bucket", 32)
    on = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.fp") < F.col("y.fp")) & (F.bit_count(apart) <= radius)
    for a, b in (("x", "y"), ("y", "x")):
        shortest = F.col(f"{b}.sizes").bitwiseAND(F.lit(low))
        on = on & (F.shiftright(f"{a}.sizes", 32) >= shortest - most_edits(shortest, similarity))
    for i, m in enumerate(chosen):  # they meet in every choice they agree on; the first one counts
        on = on & ((choice < i) | ((apart.bitwiseAND(F.lit(m)) == 0) == (choice == i)))
    return x.join(y, on).select(F.col("x.fp").alias("x"), F.col("y.fp").alias("y"))


def _word_codes(line: Column) -> Column:
    """A text with one character per word of the normalised line, so that edit distance counts words.

    The codes have five hex digits each; with the zeros between and before them a character has eight.
    """
    code = F.transform(normalised_words(line), lambda w: F.hex(F.pmod(F.xxhash64(w), F.lit(0xF0000)) + 0x10000))
    return F.decode(F.unhex(F.concat(F.lit("000"), F.array_join(code, "000"))), "UTF-32")


def _small(df: DataFrame, rows: int, width: int) -> DataFrame:
    """Broadcast a side whose counted rows of ``width`` bytes fit; beyond that the join shuffles."""
    return F.broadcast(df) if rows * width <= BROADCAST_BYTES else df


def _codes(places: DataFrame, docs: DataFrame) -> DataFrame:
    """id and codes of the lines at ``places(id, doc_id, text_key, line_no)``, in one scan of ``docs``."""
    where = places.groupBy(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key")).agg(
        F.collect_list(F.struct("id", "line_no")).alias("asked"))
    own = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    found = own.join(_small(where, places.count(), 96), own["doc_id"].eqNullSafe(F.col("_doc")) &
                     (own["text_key"] == F.col("_key")))
    # A text is split once, below the generator, however many of its lines are asked for.
    lines_of = found.select(F.split("text", "\n").alias("split"), "asked").select("split", F.explode("asked").alias("at"))
    line = F.get("split", F.col("at.line_no"))
    return stage_table(lines_of.select("at.id", _word_codes(line).alias("codes")).dropDuplicates(["id"]), "codes")


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame | None:
    """The ``pairs(a, b, ..)`` of ids of ``texts(id, codes)`` that are similar enough; None when there are no pairs."""
    pairs = stage_table(pairs, "pairs")
    if pairs.isEmpty():
        return None
    a = texts.select(F.col("id").alias("a"), F.col("codes").alias("codes_a"))
    b = texts.select(F.col("id").alias("b"), F.col("codes").alias("codes_b"))
    most = most_edits(F.greatest(F.length("codes_a"), F.length("codes_b")), similarity)
    near = F.abs(F.length("codes_a") - F.length("codes_b")) <= most
    return stage_table(pairs.join(a, "a").join(b, "b").where(near & (F.call_function(
        "levenshtein", F.col("codes_a"), F.col("codes_b"), most) >= 0)).select(*pairs.columns), "links")


def line_groups(lines: DataFrame, docs: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY,
                blocks: int = BLOCKS) -> DataFrame:
    """(key, first, component) of the distinct ``lines(key, fp, n, first)`` that are near another one.

    A line that is similar enough to none is a component of its own. Lines so short that a single edit makes them
    different can have no partner and are left out.
    """
    fewest = next(w for w in count(1) if most_edits(w, similarity))
    able = lines.where(F.col("n") >= fewest)
    fps = able.groupBy("fp").agg(F.count(F.lit(1)).alias("lines"), F.min("n").alias("shortest"), F.max("n").alias("longest"))
    fps = stage_table(fps, "fps")
    near = stage_table(near_fingerprints(fps, radius, blocks, similarity), "near")
    shared = fps.where(F.col("lines") > 1).select("fp")
    ends = near.select(F.col("x").alias("fp")).union(near.select("y")).union(shared).distinct()
    # Written with a number each; pairs, links and components are of these numbers, not of the wider keys.
    held = stage_table(able.join(ends, "fp", "left_semi").select(
        "fp", "key", "first", F.monotonically_increasing_id().alias("id")), "held")
    if held.isEmpty():
        return held.select("key", "first", F.col("id").alias("component"))
    # Every line that is compared below is one of these, so the documents are read for their words once.
    texts = _codes(held.select("id", "first.*"), docs)
    reps = held.groupBy("fp").agg(F.min("id").alias("rep"))
    held = stage_table(held.join(reps, "fp").select("fp", "key", "first", "id", "rep"), "represented")

    # Representatives of near fingerprints, and lines with the representative of their own fingerprint.
    reps = held.where(F.col("id") == F.col("rep"))
    a, b = (reps.select(F.col("fp").alias(c), F.col("id").alias(k)) for c, k in (("x", "a"), ("y", "b")))
    pairs = near.join(a, "x").join(b, "y").select("a", "b").union(
        held.where(F.col("id") != F.col("rep")).select("id", "rep"))
    groups = connected_components(_verified(pairs, texts, similarity))

    # What that leaves open: near lines of different components of which one is no representative.
    placed = stage_table(held.join(groups, held["id"] == groups["node"], "left").select(
        "fp", "key", "first", "id", (F.col("id") != F.col("rep")).alias("other"),
        F.coalesce("component", "id").alias("component")), "placed")
    a, b = placed.alias("a"), placed.alias("b")
    apart = F.col("a.component") != F.col("b.component")
    across = near.join(a, F.col("x") == F.col("a.fp")).join(b, (F.col("y") == F.col("b.fp")) & apart & (
        F.col("a.other") | F.col("b.other")))
    within = a.where("other").join(b.where("other"), (F.col("a.fp") == F.col("b.fp")) & apart & (
        F.col("a.id") < F.col("b.id")))
    ends = ["a.id", "b.id", "a.component", "b.component"]
    more = _verified(across.select(*ends).union(within.select(*ends)).toDF("a", "b", "from", "to"), texts, similarity)
    placed = placed.select("key", "first", "component")
    if more is None or more.isEmpty():
        return placed
    # Links between whole components; what the first links have tied together is not gone through again.
    tied = connected_components(more.select(F.col("from").alias("a"), F.col("to").alias("b"))).select(
        F.col("node").alias("component"), F.col("component").alias("root"))
    return placed.join(tied, "component", "left").select("key", "first", F.coalesce("root", "component").alias("component"))


def repeated_lines(docs: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY,
                   blocks: int = BLOCKS) -> DataFrame:
    """Line occurrences that are not the first of their group: doc_id, text_key, line_no."""
    segments = stage_table(line_segments(docs), "segments")
    place = F.struct(F.col("doc_id").isNull().alias("unnumbered"), "doc_id", "text_key", "line_no")
    lines = stage_table(fingerprinted(segments).groupBy("key").agg(
        F.min(place).alias("first"), F.max("fp").alias("fp"), F.max("n").alias("n"),
        F.count(F.lit(1)).alias("copies")), "distinct")
    groups = stage_table(line_groups(lines, docs, radius, similarity, blocks), "groups")
    kept = groups.groupBy("component").agg(F.min("first").alias("kept"))
    # Of the lines without a partner only those with copies have to be looked up.
    same = lines.where(F.col("copies") > 1).select("key", F.col("first").alias("kept"))
    affected = same.join(groups, "key", "left_anti").union(groups.join(kept, "component").select("key", "kept"))
    rows = segments.where(F.col("segment") == 0)
    found = rows.join(affected, "key").where(~place.eqNullSafe(F.col("kept")))
    return stage_table(found.select("doc_id", "text_key", "line_no"), "repeated")


def drop_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as struct ``doc`` with lines (count), dropped (count) and text (without the repeated lines).

    One row per input row. Lines end at a newline; blank lines and lines without a letter or digit are no
    content and stay. Of each group of equal or fuzzily equal lines the occurrence with the smallest
    (doc_id, text hash, line number) stays, null ids last. Rows with one id and one text are one
    document: they lose the same lines. A null text has no lines and stays null. An empty table gives
    no rows. Columns besides doc_id and text are carried in ``doc``, whatever their names.
    """
    gone = repeated_lines(docs, **options).groupBy(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key")).agg(
        F.collect_set("line_no").alias("gone"))
    own = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.xxhash64("text").alias("text_key"))
    met = own.join(gone, own["doc.doc_id"].eqNullSafe(gone["_doc"]) & (own["text_key"] == gone["_key"]), "left")
    text = F.col("doc.text")
    left = _let(F.split(text, "\n"), lambda ls: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("gone")), lambda i: ls[i]), "\n"))
    return met.select("doc", F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).alias("lines"),
                      F.coalesce(F.size("gone"), F.lit(0)).alias("dropped"),
                      F.when(F.col("gone").isNull(), text).otherwise(left).alias("text"))


def without_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the shortened texts; documents of which no line with content is left go.

    Documents without content from the start stay as they are.
    """
    found = drop_repeated_lines(docs, **options)
    content = F.rlike(F.coalesce("text", F.lit("")), F.lit(r"[\p{L}\p{N}]"))
    return found.where((F.col("dropped") == 0) | content).select(
        *[(F.col("text") if c == "text" else F.col("doc").getField(c)).alias(c) for c in docs.columns])
