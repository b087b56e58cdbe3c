"""Language identification by Bayesian evidence fusion (operator 10).

The text gives likelihoods under character trigram models, one for every label,
counted over all labelled documents.  To their logarithms are added: the log
prior of the host, smoothed towards its address suffix and that towards all
rows, and the log probability of the declared markup language.  Both come from
grouped counts of what the texts alone say.  A long text that no model explains
is of a language without labels: it has no name, but it is accepted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from supplyscope.llm.textscan import LOWER
from supplyscope.llm.work import byte_view, merge_join, named, session, slices, stash, text_or_empty

BUCKETS = 8192
#: Models that a task holds at a time (64 KB each); more are scored in turns.
BLOCK = 256
#: Trigrams beyond this many don't make a text's likelihood count for more.
EVIDENCE = 48
SMOOTHING = 20.0
#: Texts of fewer trigrams are too short to say that no model explains them.
LEAST_TRIGRAMS = 32
IS_LETTER = np.zeros(256, bool)
IS_LETTER[97:123] = IS_LETTER[128:] = True
#: Letters after lower-casing A-Z, any other byte as a space.
FOLD = np.where(IS_LETTER[LOWER], LOWER, 32).astype(np.uint8)
#: Odd multiplier of the trigrams' hash; its top bits are the bucket.
SPREAD = np.uint32(0x9E3779B1)


def trigrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams around a letter, and each text's first one
     (one more entry for the end).  None crosses two texts."""
    c = FOLD[data].astype(np.uint32)
    if len(c) < 3:
        return np.zeros(0, np.uint16), np.zeros(len(off), np.int64)
    code = (c[:-2] << np.uint32(16)) | (c[1:-1] << np.uint32(8)) | c[2:]
    ok = c[1:-1] != 32
    inner = off[1:-1]
    inner = inner[(inner > 0) & (inner < len(c))]
    for back in (1, 2):
        at = inner - back
        ok[at[(at >= 0) & (at < len(ok))]] = False
    place = np.flatnonzero(ok)
    return (code[place] * SPREAD >> np.uint32(19)).astype(np.uint16), np.searchsorted(place, off)


class Models:
    """Log probabilities by bucket of each language in ``names``, made a block
    of languages at a time from a written table (lang, bucket, n)."""

    def __init__(self, names: list[str], counts: DataFrame, block: int):
        self.names, self.counts, self.block = names, counts, block

    def blocks(self):
        """Arrays (languages, BUCKETS) in the order of ``names``; one at least."""
        for i in range(0, max(1, len(self.names)), self.block):
            some = self.names[i:i + self.block]
            counts = np.zeros((len(some), BUCKETS))
            if some:
                place = {x: k for k, x in enumerate(some)}
                got = self.counts.filter(F.col("lang").between(some[0], some[-1])).toArrow()
                counts[[place[x] for x in got["lang"].to_pylist()], got["bucket"].to_numpy()] = got["n"].to_numpy()
            # as many trigrams of each language, so that a large one has no edge
            p = (counts / np.maximum(1, counts.sum(axis=1, keepdims=True)) + 1e-6) / (1 + 1e-6 * BUCKETS)
            yield np.log(p)


def text_models(rows: DataFrame, label: str, block: int = BLOCK) -> tuple[list[str], Models]:
    """All languages that label a row and their models, counted over all rows
    of ``rows`` (text, ``label``) with a label."""
    known = rows.filter(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("lang"),
                                                         padded(text_or_empty(F.col("text"))).alias("text"))
    names = sorted(r.lang for r in known.select("lang").distinct().collect())

    def emit(total):
        for lang, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
                                              pa.array(counts[at], pa.int64())], names=["lang", "bucket", "n"])

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            data, off = byte_view(b.column(1))
            langs = b.column(0).to_pylist()
            for i, j in slices(np.diff(off), 1 << 20):
                g, first = trigrams(data[off[i]:off[j]], off[i:j + 1] - off[i])
                some, which = np.unique(np.array(langs[i:j], object), return_inverse=True)
                group, order = np.repeat(which, np.diff(first)), None
                if len(some) > 32:
                    order = np.argsort(group, kind="stable")
                    cut = np.searchsorted(group[order], np.arange(len(some) + 1))
                for k, lang in enumerate(some.tolist()):
                    mine = g[group == k] if order is None else g[order[cut[k]:cut[k + 1]]]
                    total[lang] = total.get(lang, 0) + np.bincount(mine, minlength=BUCKETS)
                    if len(total) >= block:
                        yield from emit(total)
                        total = {}
        yield from emit(total)

    found = known.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    return names, Models(names, stash(found, "lang-counts"), block)


def host_of(address: Column) -> Column:
    """The host of a URL, or a plain source name as it is."""
    host = F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)
    return F.lower(F.coalesce(F.when(host != "", host), address, F.lit("")))


def suffix_of(host: Column) -> Column:
    """The last label of a host, empty without a dot."""
    return F.regexp_extract(host, r"\.([^.]+)$", 1)


def declared_in(markup: Column) -> Column:
    """The primary subtag that the first html tag declares, else empty.

    The whole markup is searched.  A tag in a comment counts only if there is
    none outside; a comment that isn't closed runs to the end."""
    def attributes(col: Column) -> Column:
        # never fails once it has begun to match, so one scan is linear
        return F.regexp_extract(col, r"(?i)<html\b([^>]*+)", 1)

    bare = F.regexp_replace(markup, r"(?s)<!--.*?(?:-->|\z)", " ")
    tag = F.when(bare.rlike(r"(?i)<html\b"), attributes(bare)).otherwise(attributes(markup))
    lang = F.regexp_extract(tag, r"(?i)\blang\s*=\s*[\"']?([A-Za-z]{2,3})(?![A-Za-z])", 1)
    return F.when(markup.rlike(r"(?i)<html\b"), F.lower(lang)).otherwise("")


def visible(markup: Column) -> Column:
    """Markup without scripts, styles, comments, tags and entities."""
    bare = F.regexp_replace(markup, r"(?is)<(script|style)\b[^>]*+>.*?</\1\s*+>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"<[^>]*+>", " "), r"&[A-Za-z0-9#]{1,10};", " ")


def add_likelihoods(rows: DataFrame, models: Models) -> DataFrame:
    """(payload, host, declared, n_grams, accepted, vote, ll): log likelihoods
    by language, scaled to at most EVIDENCE trigrams; vote is the place of the
    best language, null for a text without letters and for one of LEAST_TRIGRAMS
    or more that every model explains worse than an even spread would.

    Each block of models is a pass over the texts; all but the last write them
    again with the likelihoods so far."""
    spark = rows.sparkSession
    payload, n_lang = rows.schema["payload"], len(models.names)
    rows = rows.withColumn("ll", F.array().cast("array<double>"))
    for done, logp in enumerate(models.blocks()):
        last = (done + 1) * models.block >= n_lang
        ddl = "host string, declared string" + (", n_grams long, accepted boolean, vote int" if last else ", text string") + ", ll array<double>"
        rows = rows.mapInArrow(score(spark.sparkContext.broadcast(logp), done * models.block, n_lang, last),
                               T.StructType([payload, *T.StructType.fromDDL(ddl).fields]))
        if not last:
            rows = stash(rows, "lang-block")
    return rows


def score(shipped, before: int, n_lang: int, last: bool):
    """A pass of ``add_likelihoods`` for one block of models, ``before`` of
    them having been scored."""
    def run(batches):
        logp = shipped.value
        for whole in batches:
            sizes = np.diff(byte_view(whole.column("text"))[1]) + 8 * n_lang
            for i, j in slices(sizes, 4 << 20):
                b = whole.slice(i, j - i)
                data, off = byte_view(b.column("text"))
                sums, n = likelihoods(data, off, logp)
                weight = np.minimum(n, EVIDENCE) / np.maximum(1, n)
                ll = np.concatenate([b.column("ll").flatten().to_numpy(zero_copy_only=False).reshape(j - i, before), sums * weight[:, None]], axis=1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1) * ll.shape[1], pa.int32()), pa.array(ll.ravel()))
                cols = {x: b.column(x) for x in ("payload", "host", "declared")}
                if last:
                    cols |= {"n_grams": pa.array(n, pa.int64()), "accepted": pa.array(n > 0),
                             "vote": vote(ll, n)}
                else:
                    cols["text"] = b.column("text")
                yield pa.RecordBatch.from_pydict({**cols, "ll": lists})
    return run


def likelihoods(data: np.ndarray, off: np.ndarray, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's log likelihood by language, and its number of trigrams."""
    parts, counts = [np.zeros((0, len(logp)))], [np.zeros(0, np.int64)]
    for i, j in slices(np.diff(off), 1 << 20):
        g, first = trigrams(data[off[i]:off[j]], off[i:j + 1] - off[i])
        n = np.diff(first)
        sums = np.zeros((j - i, len(logp)))
        full = np.flatnonzero(n)
        if len(full):
            for k in range(len(logp)):
                sums[full, k] = np.add.reduceat(logp[k][g], first[:-1][full])
        parts.append(sums)
        counts.append(n)
    return np.concatenate(parts), np.concatenate(counts)


def vote(ll: np.ndarray, n: np.ndarray) -> pa.Array:
    if not ll.shape[1]:
        return pa.nulls(len(n), pa.int32())
    # mean log2 probability of a trigram above that of an even spread
    fit = ll.max(axis=1) / np.maximum(1, np.minimum(n, EVIDENCE)) / np.log(2) + np.log2(BUCKETS)
    return pa.array(ll.argmax(axis=1).astype(np.int32), mask=(n == 0) | ((n >= LEAST_TRIGRAMS) & (fit <= 0)))


def listed(votes: DataFrame, key: str, name: str) -> DataFrame:
    """Counts by ``key`` and vote as one list a key, without null votes."""
    counts = votes.groupBy(key, "vote").agg(F.sum("n").alias("n"))
    return counts.groupBy(key).agg(F.collect_list(F.when(F.col("vote").isNotNull(), F.struct("vote", "n"))).alias(name))


def unlisted(lists: pa.Array, n: int) -> np.ndarray:
    """The counts of ``listed`` as rows of ``n`` numbers; zeros for a null."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten()
    row = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    out = np.zeros((len(lists), n))
    out[row, flat.field("vote").to_numpy(zero_copy_only=False)] = flat.field("n").to_numpy(zero_copy_only=False)
    return out


def smoothed(counts: np.ndarray, parent: np.ndarray) -> np.ndarray:
    return (counts + SMOOTHING * parent) / (counts.sum(axis=1, keepdims=True) + SMOOTHING)


def fuse(rows: DataFrame, names: list[str]) -> DataFrame:
    """Adds lang, posterior, text_lang and accepted to ``add_likelihoods``'s
    rows, which must be a written table."""
    n = len(names)
    if not n:
        return rows.select("payload", F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("posterior"),
                           F.lit(None).cast("string").alias("text_lang"), "accepted")
    votes = stash(rows.groupBy("host", "vote").agg(F.count("*").alias("n")).withColumn("suffix", suffix_of(F.col("host"))), "lang-votes")
    total = np.ones(n)
    for r in votes.filter("vote is not null").groupBy("vote").agg(F.sum("n").alias("n")).collect():
        total[r.vote] += r.n
    hosts = listed(votes, "host", "by_host").withColumn("suffix", suffix_of(F.col("host")))
    priors = stash(merge_join(hosts, listed(votes, "suffix", "by_suffix"), "suffix").select("host", "by_host", "by_suffix"), "lang-priors")
    # at most 26^2 + 26^3 declared values; lists of many languages are no longer small
    said = listed(rows.select("declared", "vote", F.lit(1).alias("n")), "declared", "by_declared")
    fused = merge_join(rows, priors, "host")
    fused = fused.join(F.broadcast(said), "declared") if n <= BLOCK else merge_join(fused, stash(said, "lang-said"), "declared")

    def run(batches):
        for b in batches:
            ll = b.column("ll").flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
            prior = smoothed(unlisted(b.column("by_host"), n), smoothed(unlisted(b.column("by_suffix"), n), total / total.sum()))
            # P(declared | language), smoothed towards P(declared); "" is no declaration
            declared = unlisted(b.column("by_declared"), n)
            declared = (declared + SMOOTHING * (declared.sum(axis=1, keepdims=True) + 1) / total.sum()) / (total + SMOOTHING)
            post = ll + np.log(prior) + np.log(declared)
            sure = 1 / np.exp(post - post.max(axis=1, keepdims=True, initial=-np.inf)).sum(axis=1)
            unsaid = pc.is_null(b.column("vote")).to_numpy(zero_copy_only=False)
            strange = unsaid & (b.column("n_grams").to_numpy() > 0)
            place = lambda k, none: pa.array([None if x else names[i] for i, x in zip(k, none.tolist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_pydict({
                "payload": b.column("payload"), "lang": place(post.argmax(axis=1).tolist(), unsaid),
                "posterior": pa.array(np.where(strange, 0.0, sure)), "text_lang": place(ll.argmax(axis=1).tolist(), unsaid),
                "accepted": b.column("accepted")})

    out = fused.select("payload", "n_grams", "accepted", "vote", "ll", "by_host", "by_suffix", "by_declared").mapInArrow(
        run, T.StructType([rows.schema["payload"], *T.StructType.fromDDL(
            "lang string, posterior double, text_lang string, accepted boolean").fields]))
    return out.withColumn("posterior", F.round("posterior", 6))


def padded(text: Column) -> Column:
    """Spaces around, so that first and last letters have trigrams too."""
    return F.concat(F.lit(" "), text, F.lit(" "))


def rows_of(df: DataFrame, payload: list[Column], text: Column, address: Column, markup: bool) -> DataFrame:
    """(payload, text, host, declared) of a table."""
    raw = text_or_empty(text)
    return df.select(F.struct(*payload).alias("payload"), padded(visible(raw) if markup else raw).alias("text"),
                     host_of(address).alias("host"), declared_in(raw).alias("declared"))


def identify(rows: DataFrame, names: list[str], models: Models) -> DataFrame:
    """One row per row of ``rows``: payload, lang, posterior, text_lang (what
    the text alone says) and accepted.

    A text without letters (null, empty, digits) has no language and isn't
    accepted; any other is, whatever its script: a byte from 128 on counts as
    part of a letter.  One of LEAST_TRIGRAMS or more that every model explains
    worse than an even spread would is of a language without labels: lang and
    text_lang are null, posterior is 0.  A text of two languages is named by
    the likelier, its posterior tells how sure that is.  Null addresses share
    one host; repeated rows count each time; null ids pass through; an empty
    table gives no rows; long texts are scored whole, in pieces of a batch;
    columns travel in the struct ``payload``, so names can't clash.
    """
    session(rows)
    return fuse(stash(add_likelihoods(rows, models), "lang-rows"), names)


def language_rows(docs: DataFrame, text_col: str = "text", label_col: str = "lang", address_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``identify`` accepts, with the language that it
    names in ``label_col`` (where it names none, the label stays).

    Models are counted over the labelled rows of ``docs`` itself.  Edge cases
    are those of ``identify``; all columns stay, whatever their names."""
    session(docs)
    names, models = text_models(docs.select(docs[text_col].alias("text"), docs[label_col].alias("label")), "label")
    rows = rows_of(docs, [named(docs, c).alias(c) for c in docs.columns], docs[text_col], docs[address_col], False)
    out = identify(rows, names, models).where("accepted")
    row = F.col("payload")
    found = F.coalesce(F.col("lang"), row.getField(label_col).cast("string")).alias(label_col)
    return out.select(*[found if c == label_col else row.getField(c).alias(c) for c in docs.columns])
