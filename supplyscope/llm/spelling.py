"""Spelling variants: words one edit apart, and the form each belongs to (operator 12).

A trie frontier in relations.  States (word, position, node, edits) are joined,
level by level, with the edge table of a trie of all words; a state that ends on
a word with one edit makes the two neighbours.  Four things keep the frontier
small without losing a pair:

* the trie is compressed: a node is a place where words part, its edge carries
  the letters up to the next one, and an edge to a single word carries the rest
  of it, so the levels follow the branchings on a path, not the letters;
* two unlike words part at a node of the trie, so a word walks its own path
  without edits and makes its one edit only there;
* an edge tells, in two sets of 64 bits, which sizes and endings the words below
  it have; an edited state has only exact letters left, so it goes no further
  where no word of its size and ending is;
* there are two tries, of the words and of the words turned round.  An edit in
  the later half of a word is found from the front, the others from the back, so
  none happens near a root, where nearly every letter goes on.

A node is known by its level and the least row number below it; its letters are
what the first and the last word below it share, so no group is ever collected.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplyscope.llm.work import byte_view, merge_join, session, stash, text_or_empty

RUN = re.compile("[A-Za-zÀ-ÿ]+")
NOT_RUN = re.compile("[^A-Za-zÀ-ÿ]")
#: A-Z to a-z, every other byte of UTF-8 unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words a task holds before it passes their counts on.
HELD = 200_000
#: Last letters that an edge tells of the words below it.
ENDINGS = (3, 5)
#: Characters of a text that are split at once.
PIECE = 1 << 20


def pieces(text: str):
    """A text in pieces that end where no run does; a longer run stays whole."""
    i = 0
    while len(text) - i > PIECE:
        m = NOT_RUN.search(text, i + PIECE)
        if m is None:
            break
        yield text[i:m.start()]
        i = m.end()
    yield text[i:]


def counted(typo_every: int | None):
    """mapInArrow function: (word, n) of the runs in (id, text), added up as
    far as a task can hold them."""
    def run(batches):
        total: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())],
                                             names=["word", "n"])
            total.clear()
            return out

        for b in batches:
            data, off = byte_view(b.column(1))
            low, ends = LOWER[data].tobytes(), off.tolist()
            for name, i, j in zip(b.column(0).to_pylist(), ends, ends[1:]):
                seed = crc32(f"{'' if name is None else name}:".encode())
                for piece in pieces(low[i:j].decode()):
                    runs = RUN.findall(piece)
                    total.update(runs)
                    if typo_every:
                        odd = {w for w in set(runs) if not crc32(w.encode(), seed) % typo_every}
                        for w, n in Counter(w for w in runs if w in odd).items() if odd else ():
                            at = crc32(w.encode(), seed) % len(w)
                            total[w] -= n
                            total[w[:at] + w[at + 1:]] += n
                    if len(total) > HELD:
                        yield flush()
        yield flush()
    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5,
                min_count: int = 3, typo_every: int | None = None) -> DataFrame:
    """(word, n): the runs of Latin letters of all texts, A-Z lower-cased, of at
    least ``min_length`` code points and ``min_count`` occurrences.

    With ``typo_every`` a run whose crc32 of ``<id>:<run>`` it divides loses
    one code point first.  Null and empty texts have no words, a null id counts
    as an empty one, repeated rows count each time.
    """
    kept = docs.select(docs[id_col].cast("string").alias("id"), text_or_empty(docs[text_col]).alias("text"))
    parts = kept.mapInArrow(counted(typo_every), "word string, n long").where(F.char_length("word") >= min_length)
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def shared(a: Column, b: Column) -> Column:
    """How many first code points two unlike texts share."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x.eqNullSafe(y))
    return (F.array_position(same, False) - 1).cast("int")


def ending(size: Column, s: Column, letters: int) -> Column:
    """One bit of 64 for a word's size and last letters."""
    place = F.pmod(F.xxhash64(size.cast("int"), F.right(s, F.lit(letters))), F.lit(64)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def edges_of(states: DataFrame, keys: list, letter: Column) -> DataFrame:
    """The edge table of a level: for each node and next letter the child (the
    least row number below it), the number of words, one word, the depth to
    which all of them agree, and bits of the sizes and endings below."""
    grouped = states.groupBy(*keys, letter.alias("letter")).agg(
        F.min("id").alias("child"), F.count("*").alias("words"), F.min("s").alias("lo"), F.max("s").alias("hi"), F.min("n").alias("lo_n"),
        *[F.bit_or(ending(F.col("size"), F.col("s"), k)).alias(f"end{k}") for k in ENDINGS])
    deep = F.when(F.col("words") == 1, F.char_length("lo")).otherwise(shared(F.col("lo"), F.col("hi")))
    return grouped.withColumn("deep", deep).drop("hi")


def start(words: DataFrame, depth: int) -> DataFrame:
    """Every word of (id, word, n) at its first node, in both tries.  ``least``
    is the depth from which on it may be edited."""
    size = F.char_length("word")
    half = F.floor(size / 2).cast("int")
    sides = F.array(F.struct(F.lit(False).alias("back"), F.col("word").alias("s"), half.alias("least")),
                    F.struct(F.lit(True).alias("back"), F.reverse("word").alias("s"), (size - half).alias("least")))
    rows = words.select("id", "n", size.alias("size"), F.inline(sides)).withColumn("letter", F.substring("s", 1, depth))
    edges = edges_of(rows.drop("letter"), ["back"], F.substring("s", 1, depth)).where("words > 1")
    return merge_join(rows, edges.select("back", "letter", "child", "deep"), ["back", "letter"]).select(
        "back", "id", "n", "s", "size", "least", F.col("deep").alias("pos"), F.col("child").alias("node"),
        F.col("deep").alias("depth"), F.lit(0).alias("edits"), F.col("size").alias("want"))


def step(states: DataFrame) -> DataFrame:
    """One level: each state along the edges that it can take.  A row with
    ``other`` is a pair of neighbours, the others are the next level's states.

    A state that knows its next letter (on its own path, after its edit, or when
    its edit leaves a letter out) is joined with the one edge of that letter.
    One whose edit is any other letter is joined with the single words of its
    node by all the letters that are left, and with the other edges pair by
    pair, whose sizes and endings are compared as bits."""
    depth, pos, size, s = (F.col(c) for c in ("depth", "pos", "size", "s"))
    letter, lo, deep, words, label, left = (F.col(c) for c in ("letter", "lo", "deep", "words", "label", "left"))
    path = states.where("edits = 0").select("back", "id", "n", "s", "size", "node", "depth")
    edges = edges_of(path, ["back", "node", "depth"], F.substring("s", depth + 1, F.lit(1)))
    # an edge's letters after the first
    edges = stash(edges.select(
        "back", "node", "letter", "child", "words", "lo", "lo_n", "deep", *[f"end{k}" for k in ENDINGS],
        F.substring(lo, depth + 2, deep - depth - 1).alias("label"), F.greatest(deep - depth - 1, F.lit(0)).alias("left")), "spelling-edges")
    keys, kept = ["back", "node"], ["back", "id", "n", "s", "size", "least"]

    def at(i: Column) -> Column:
        return F.substring(s, i + 1, F.lit(1))

    def rest(i: Column) -> Column:
        return F.substring(s, i + 1, size)

    def bits(want: Column, name: str) -> dict:
        """What the endings of the words sought are, for words of a size."""
        return {f"{name}{k}": ending(want, s, k) for k in ENDINGS}

    def goes_on(tail: Column, begin: Column, name: str) -> Column:
        """Whether the word's letters from ``begin`` on, ``tail``, go on as the
        edge does after its first letter, and may end as a word below it does;
        at a single word they are all the rest."""
        after = size - begin - left
        ends = after >= 0
        for k in ENDINGS:
            # endings that reach back before these letters say nothing
            ends = ends & ((after < k) | (F.col(f"end{k}").bitwiseAND(F.col(f"{name}{k}")) != 0))
        return F.when(words == 1, after == 0).otherwise(ends) & F.startswith(tail, label)

    def moved(rows: DataFrame, new_pos: Column, edits: Column, want: Column) -> DataFrame:
        return rows.select(*kept, new_pos.alias("pos"), F.col("child").alias("node"), deep.alias("depth"), edits.alias("edits"),
                           want.alias("want"), (words == 1).alias("found"), "lo", "lo_n")

    edited, own = F.col("edits") == 1, at(depth)
    may = ~edited & (depth >= F.col("least"))

    def ask(edits: int, what: Column, place: Column, want: Column) -> Column:
        return F.struct(F.lit(edits).alias("edits"), what.alias("letter"), place.alias("place"), want.alias("want"))

    asks = F.array(F.when(edited, ask(1, at(pos), pos, F.col("want"))), F.when(~edited, ask(0, own, depth, size)),
                   F.when(may & (own != "") & (at(depth + 1) != own), ask(1, at(depth + 1), depth + 1, size - 1)))
    asked = states.select(*kept, "node", F.explode(asks).alias("ask")).where("ask IS NOT NULL").select(*kept, "node", "ask.*")
    asked = asked.withColumns(bits(F.col("want"), "end_of"))
    begin = F.col("place") + F.when(letter == "", 0).otherwise(1)  # a word's end has no letter
    known = merge_join(asked, edges, [*keys, "letter"])
    stays = F.col("edits") == 0
    known = known.where((stays & (words > 1)) | (~stays & goes_on(rest(begin), begin, "end_of")))
    out = moved(known, F.when(stays, deep).otherwise(begin + left), F.col("edits"), F.col("want"))

    # the first unlike letter is another one, or one more
    free = states.where(may).select(*kept, "node", "depth", own.alias("own"))
    tails = F.array(F.when(F.col("own") != "", F.struct(rest(depth + 1).alias("label"), size.alias("want"))),
                    F.struct(rest(depth).alias("label"), (size + 1).alias("want")))
    single = free.select(*kept, "node", "own", F.explode(tails).alias("tail")).where("tail IS NOT NULL").select(*kept, "node", "own", "tail.*")
    alone = edges.where((words == 1) & (letter != "")).select(*keys, "label", "letter", "child", "words", "lo", "lo_n", "deep")
    single = merge_join(single, alone, [*keys, "label"]).where(letter != F.col("own"))
    out = out.unionByName(moved(single, size, F.lit(1), F.col("want")))

    free = free.withColumns({**bits(size, "same"), **bits(size + 1, "more"), "same_rest": rest(depth + 1), "more_rest": rest(depth)})
    changed = (F.col("own") != "") & goes_on(F.col("same_rest"), depth + 1, "same")
    longer = goes_on(F.col("more_rest"), depth, "more")
    many = edges.where(words > 1).withColumnsRenamed({"back": "_back", "node": "_node"}).hint("merge")
    pairs = free.join(many, (F.col("back") == F.col("_back")) & (F.col("node") == F.col("_node")) & (letter != F.col("own")) & (changed | longer))
    for when, i, want in ((changed, depth + 1, size), (longer, depth, size + 1)):
        out = out.unionByName(moved(pairs.where(when).drop("node"), i + left, F.lit(1), want))

    half = F.floor(size / 2).cast("int")
    # the back trie keeps what the front one can't find: words that differ in their first half
    found, missed = F.col("found"), ~F.col("back") | ~F.right(s, half).eqNullSafe(F.right(lo, half))
    return out.where(~found | missed).select(
        *kept, "pos", "node", "depth", "edits", "want",
        F.when(found, F.when(F.col("back"), F.reverse(lo)).otherwise(lo)).alias("other"), F.when(found, F.col("lo_n")).alias("other_n"))


def neighbours(words: DataFrame, min_length: int) -> DataFrame:
    """(id, other, other_n): every pair of words of (id, word, n) that are one
    edit apart, in both directions, each once."""
    states = stash(start(words, min_length // 2), "spelling-start")
    found = states.sparkSession.createDataFrame([], "id long, other string, other_n long")
    while not states.isEmpty():
        level = stash(step(states), "spelling-level")
        found = found.unionByName(level.where("other IS NOT NULL").select("id", "other", "other_n"))
        states = level.where("other IS NULL").drop("other", "other_n")
    return found


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last, by jumping
    to the form's root so far; counts grow along a chain, so it ends."""
    now = stash(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while not now.where("moved").isEmpty():
        far = now.select(F.col("word").alias("root"), F.col("root").alias("far"))
        now = stash(merge_join(now.drop("moved"), far, "root", "left").select(
            "word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "spelling-roots")
    return now.select("word", "root")


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5,
                    min_count: int = 3, times: int = 2, typo_every: int | None = None) -> DataFrame:
    """One row per word (see ``word_counts``): word, form, root, n, n_near,
    form_n.

    Words are near if they differ by one inserted, deleted or replaced code
    point.  ``form`` is the near word of largest n (of equal ones the first in
    code-point order) if that is at least ``times`` n, else null; ``root``
    follows forms to the last, and is the word itself if it has none; ``n_near``
    is 0 without near words.  Rows of a text that is null or empty add nothing;
    repeated rows count again; an empty table gives no rows; long texts are
    split in pieces; no other column is read, so names can't clash.
    """
    session(docs)
    counts = word_counts(docs, id_col, text_col, min_length, min_count, typo_every)
    words = stash(counts.withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    best = neighbours(words, min_length).groupBy("id").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    form = F.when(-F.col("best.less") >= F.col("n") * times, F.col("best.other"))
    near = stash(merge_join(words, best, "id", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("form"),
        F.when(form.isNotNull(), -F.col("best.less")).alias("form_n")), "spelling-near")
    ends = roots(near.where("form IS NOT NULL").select("word", "form"))
    return merge_join(near, ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
