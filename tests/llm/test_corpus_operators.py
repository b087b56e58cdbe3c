"""Duplicates, repeats, mixing and models against plain versions."""

import re
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest

from supplyscope.llm import decontaminate, language, neardup, quality, repeats
from supplyscope.llm.components import components
from supplyscope.llm.exact import exact_groups
from supplyscope.llm.mixing import Mix, mix_report, mixed_rows
from supplyscope.llm.neardup import near_duplicates, prefix_depth


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def check_exact(df):
    got = exact_groups(df).collect()
    assert len(got) == df.count()
    groups = {}
    for r in df.select("doc_id", "text").collect():
        groups.setdefault((r.text or "").translate(brute.AZ), []).append(r.doc_id)
    want = sorted(str((d, max((x for x in ids if x is not None), default=None), len(ids), brute.sha(t))) for t, ids in groups.items() for d in ids)
    assert sorted(str((r.id, r.keep_id, r.group_size, r.text_sha256)) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)


def test_exact_groups(spark, small, odd_docs, no_docs):
    check_exact(small)
    check_exact(odd_docs)
    assert exact_groups(no_docs).collect() == []
    # texts of one length that differ late, at every width of a digit
    stem = "A" * 20_000
    late = [stem[:k] + c + stem[k + 1:] for k in (0, 63, 64, 1023, 1024, 16_383, 16_384, 19_999) for c in "xyX"]
    check_exact(spark.createDataFrame(list(enumerate(late)), "doc_id long, text string"))


def test_exact_keeps_all_columns(odd_docs):
    out = exact_groups(odd_docs, carry=tuple(odd_docs.columns)).filter("kept").select("carry.*")
    assert out.columns == odd_docs.columns
    assert out.count() == len({(r.text or "").translate(brute.AZ) for r in odd_docs.collect()})


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


def test_prefix_depth_follows_recall():
    assert prefix_depth(0.8, 20, 5, 0.9999) == 4
    assert prefix_depth(0.8, 20, 5, 0.999) == 5
    assert prefix_depth(0.1, 2, 5, 0.99) == 1


def check_near(df, pairs, **kw):
    got = near_duplicates(df, **kw).collect()
    docs = [(d if d is not None else -1, t) for d, t in pairs(df)]
    assert sorted((-1 if r.id is None else r.id, r.class_size, r.n_links) for r in got) == sorted((a, c, d) for a, _, c, d in brute.near(docs))
    return got


def test_near_duplicates(small, odd_docs, no_docs, pairs):
    got = check_near(small, pairs)
    assert sorted((r.id, r.class_id) for r in got) == sorted(x[:2] for x in brute.near(pairs(small)))
    assert sum(r.kept for r in got) == len({r.class_id for r in got})
    check_near(odd_docs, pairs)
    assert near_duplicates(no_docs).collect() == []


def test_near_duplicates_of_one_large_family(spark, pairs, monkeypatch):
    """More members than a block holds: block pairs give the same links."""
    from supplyscope.llm import neardup
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for _ in range(90):
        t = list(base)
        for k in rng.integers(0, 120, size=rng.integers(0, 4)):
            t[k] = f"q{rng.integers(0, 9)}"
        texts.append(" ".join(t))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_near(df, pairs)


def test_difference_cover_covers():
    for r in range(5):
        v, d = repeats.difference_cover(r)
        assert len(d) == 6 * r + 4
        assert {int(a - b) % v for a in d for b in d} == set(range(v))


def check_repeats(df, pairs, **kw):
    got = repeats.remove_repeats(df, **kw)
    assert rows(got) == sorted(map(str, brute.repeats(pairs(df), kw.get("length", 400))))


def test_repeats(spark, sf_small, odd_docs, no_docs, pairs):
    from pyspark.sql import functions as F
    first = spark.read.parquet(f"{sf_small}/documents.parquet").filter(F.length("text") < 4000)
    check_repeats(first, pairs)
    check_repeats(first.repartition(5), pairs, bucket_names=100, chunk_bytes=5000)
    check_repeats(odd_docs.filter("coalesce(length(text), 0) < 9000"), pairs)
    assert repeats.remove_repeats(no_docs).collect() == []


def test_repeats_of_three_texts_that_share_unlike_stretches(spark, pairs):
    rng = np.random.default_rng(5)
    a = "".join(chr(97 + c) for c in rng.integers(0, 26, 3000))
    b = "".join(chr(97 + c) for c in rng.integers(0, 26, 3000))
    texts = [a, b[:500] + a[300:2400] + b[500:900], b[:77] + a[1000:1410] + b[1200:1600], "ab" * 600, "é" * 150 + a[:399], a[:400] + "z"]
    for n in (1, 4):
        check_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(n), pairs, chunk_bytes=3500)


def check_mix(df):
    mix = Mix(df)
    got = mix_report(mix).collect()
    assert len(got) == df.count()
    sizes, taken, largest, source_of = {}, {}, {}, {}
    for r in df.select("doc_id", "text", "source").collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        sizes[r.source] = sizes.get(r.source, 0) + n
        source_of[r.doc_id, n] = r.source
        largest[r.source] = max(largest.get(r.source, 0), n)
    want = brute.targets(sizes)
    for r in got:
        s = source_of[r.id, r.size]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s]) and r.taken <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1.5 * largest[s]
    assert sorted(map(str, map(tuple, got))) == rows(mix_report(Mix(df)))
    return mix, sum(taken.values())


def test_mix(small):
    mix, words = check_mix(small)
    out = mixed_rows(small, mix).collect()
    assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in out) == words


def test_mix_odd_rows(odd_docs, no_docs):
    check_mix(odd_docs.filter("doc_id is not null").dropDuplicates(["doc_id"]))
    assert mix_report(Mix(odd_docs)).count() == odd_docs.count()
    assert mixed_rows(odd_docs, Mix(odd_docs)).columns[:len(odd_docs.columns)] == odd_docs.columns
    assert mix_report(Mix(no_docs)).collect() == []
    assert mixed_rows(no_docs, Mix(no_docs)).collect() == []


def check_words_by_source(df):
    """Each source's taken words are near its target, whatever rows repeat;
    sources are told by their size."""
    sizes, largest = {}, {}
    for r in df.select("text", "source").collect():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        sizes[r.source] = sizes.get(r.source, 0) + n
        largest[r.source] = max(largest.get(r.source, 0), n)
    want, taken = brute.targets(sizes), {}
    mix = Mix(df)
    got = mix_report(mix).collect()
    assert len(got) == df.count() and len({n for n in sizes.values() if n}) == sum(n > 0 for n in sizes.values())
    for r in got:
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
        assert r.taken <= 2 * r.size
    for s, n in sizes.items():
        assert n == 0 or abs(taken[n] - want[s]) <= 1.5 * largest[s], (s, taken[n], want[s])
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in mixed_rows(df, mix).select("text").collect())
    assert words == sum(taken.values())
    assert sorted(map(str, map(tuple, got))) == rows(mix_report(Mix(df.repartition(2))))


def test_mix_of_repeated_rows(spark, odd_docs):
    check_words_by_source(odd_docs)
    same = [(None, "five words of one text", "a")] * 600 + [(7, "some words", "b")] * 300 + [(8, "a b c", "b")] * 3
    more = [(i, "word " * (i % 9), "c") for i in range(100)] + [(i, "w " * 11, None) for i in range(50)]
    check_words_by_source(spark.createDataFrame(same + more, "doc_id long, text string, source string").repartition(5))


def test_mix_shards_have_equal_quotas(small):
    mix = Mix(small, block_rows=2, shard_words=3000)
    per = [r["count"] for r in mix.instances.groupBy("shard").count().collect()]
    assert len(per) == mix.shards > 5 and max(per) - min(per) <= mix.shards.bit_length()


def test_quality_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = quality.quality_scores(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, None), (3, 1, 0), (None, 1, 1), (9, None, 0), (5, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    assert quality.quality_scores(odd_docs, labels).count() == odd_docs.count()
    assert quality.quality_scores(odd_docs, labels.limit(0)).count() == odd_docs.count()
    assert quality.quality_scores(no_docs, labels).collect() == []


def test_trees_learn_a_rule():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 5)).astype(np.float32)
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    model = quality.grow(x, y, trees=60)
    assert ((model.score(x) > 0.5) == y).mean() > 0.97


def test_language(spark, odd_docs, no_docs):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    learn = docs.filter(~quality.held_out(docs["doc_id"]))
    names, logp = language.text_models(learn.select("text", "lang"), "lang")
    assert names == ["de", "en", "es", "fr"]
    out = language.identify(language.rows_of(docs, [docs["doc_id"], docs["lang"].alias("said")], docs["text"], docs["source"], False), names, logp)
    held = [r for r in out.select("payload.*", "lang", "accepted").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert np.mean([r.said == r.lang for r in held]) >= 0.98 and all(r.accepted for r in held)
    odd = language.identify(language.rows_of(odd_docs, [odd_docs["doc_id"]], odd_docs["text"], odd_docs["source"], False), names, logp)
    assert odd.count() == odd_docs.count()
    assert all(r.lang is None and not r.accepted for r in odd.collect() if r.payload.doc_id in (1, 2, 7))
    kept = language.language_rows(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 4
    assert language.language_rows(no_docs).collect() == []


def test_language_fuses_markup_and_host(spark):
    pages = [(i, f"https://a{i % 3}.example.de/x", '<html lang="de"><p>Das ist der Text und die Sprache</p><script>the the</script>') for i in range(30)]
    pages += [(100, "https://a1.example.de/y", "<html><p>it</p>"), (101, "https://b.example.fr/y", '<html LANG=fr-FR class="x"><p>it</p>'), (102, None, None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    train = spark.createDataFrame([("das ist der text und die sprache it", "de"), ("the text is in this language it", "en"),
                                   ("le texte est dans cette langue it", "fr")], "text string, lang string")
    names, logp = language.text_models(train, "lang")
    out = language.identify(language.rows_of(df, [df["page_id"]], df["html"], df["url"], True), names, logp)
    got = {r.payload.page_id: r for r in out.collect()}
    assert got[0].lang == "de" and got[100].lang == "de" and got[102].lang is None
    assert language.rows_of(df, [df["page_id"]], df["html"], df["url"], True).filter("payload.page_id = 101").first().declared == "fr"


FINNISH = ("kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto "
           "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä ")
RUSSIAN = "все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом и совестью "


def test_language_models_every_label(spark):
    """The least of 140 labels is named, whatever the models a task holds."""
    rng = np.random.default_rng(2)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 9)) for _ in range(140 * 6)]
    train = [(" ".join(words[6 * k:6 * k + 6]), f"l{k:03}") for k in range(140) for _ in range(2 if k < 139 else 1)]
    df = spark.createDataFrame(train, "text string, lang string")
    docs = df.selectExpr("monotonically_increasing_id() doc_id", "*", "concat('http://', lang, '.x/') source")
    got = []
    for block in (256, 50):
        names, models = language.text_models(df, "lang", block=block)
        assert len(names) == 140
        out = language.identify(language.rows_of(docs, [docs["lang"].alias("said")], docs["text"], docs["source"], False), names, models)
        assert all(r.lang == r.text_lang == r.payload.said for r in out.collect())
        got.append(rows(out))
    assert got[0] == got[1]


SCRIPTS = {
    "zh": "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待人人有资格享有本宣言所载的一切权利和自由",
    "ja": "すべての人間は生まれながらにして自由でありかつ尊厳と権利とについて平等である人間は理性と良心とを授けられており",
    "ko": "모든 인간은 태어날 때부터 자유로우며 그 존엄과 권리에 있어 동등하다 인간은 천부적으로 이성과 양심을 부여받았으며 ",
    "th": "มนุษย์ทั้งหลายเกิดมามีอิสระและเสมอภาคกันในเกียรติศักดิ์และสิทธิต่างมีเหตุผลและมโนธรรม",
    "ar": "يولد جميع الناس أحرارا متساوين في الكرامة والحقوق وقد وهبوا عقلا وضميرا وعليهم أن يعامل بعضهم بعضا بروح الإخاء ",
    "hi": "सभी मनुष्यों को गौरव और अधिकारों के मामले में जन्मजात स्वतन्त्रता और समानता प्राप्त है ",
}


def test_language_keeps_texts_of_languages_without_labels(spark):
    known = [(i, t * 3, lang, None) for i, (t, lang) in enumerate([("the text is in this language it ", "en"), ("das ist der text ", "de")])]
    more = [(10, FINNISH * 9, None, None), (11, RUSSIAN * 9, None, None), (12, FINNISH, None, None), (14, "12 34", None, None)]
    scripts = [(20 + 10 * i + k, t * k, None, None) for i, t in enumerate(SCRIPTS.values()) for k in (1, 3, 9)]
    df = spark.createDataFrame(known + more + scripts, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.lang for r in language.language_rows(df).collect()}
    assert kept == {r[0]: r[2] for r in known + more + scripts if r[0] != 14}
    names, models = language.text_models(df, "lang")
    out = language.identify(language.rows_of(df, [df["doc_id"]], df["text"], df["source"], False), names, models).collect()
    assert {r.payload.doc_id: (r.lang, r.accepted) for r in out} == {
        r[0]: (r[2], r[0] != 14) for r in known + more + scripts}


def test_language_names_texts_of_any_script(spark):
    """With labels the six scripts are named, in rows without labels too."""
    rows_ = [(10 * i + k, t * k, lang if k < 4 else None, None) for i, (lang, t) in enumerate(SCRIPTS.items()) for k in range(1, 6)]
    df = spark.createDataFrame(rows_, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.lang for r in language.language_rows(df).collect()}
    assert got == {10 * i + k: lang for i, lang in enumerate(SCRIPTS) for k in range(1, 6)}


def test_language_declared_anywhere_in_the_markup(spark):
    fill = "x " * 2500
    pages = {f"<!-- {fill} --><html lang=de>": "de", f"<!-- <html lang=en> {fill} -->\n<!DOCTYPE html><HTML class='a' Lang='fr-CA'>": "fr",
             " " * 9000 + '<html lang="es">': "es", "<html><p><html lang=de>": "", "<!-- open <html lang=it>" + fill: "it",
             "<!-- open " * 20_000 + "<html " * 20_000: "", "<html dir=ltr>" + fill + "lang=de": "", "no markup lang=de": ""}
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    got = df.select("page_id", language.declared_in(df["html"]).alias("d")).orderBy("page_id").collect()
    assert [r.d for r in got] == list(pages.values())


def test_language_query_counts_every_labelled_document(spark, tmp_path):
    """A language found only in rows that op1 holds out has a model."""
    from supplyscope.llm.queries import QUERIES
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2][:5]
    docs = [(i, "the text is in this language it ", "en", "a") for i in range(200) if i not in held] + [(i, FINNISH, "fi", "b") for i in held]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "http://a.fi/", f"<p>{FINNISH}</p>")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    out = QUERIES["op10_language_id"](spark, str(tmp_path)).collect()
    assert {r.lang for r in out if r.doc_id in held or r.page_id == 1} == {"fi"} and all(r.accepted for r in out)


def alternating(order, a, b):
    """Words a and b in the order of the Thue-Morse sequence, where sums of
    powers cancel, and the same with a and b exchanged."""
    bits = [0]
    for _ in range(order):
        bits += [1 - x for x in bits]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


@pytest.mark.parametrize("a, b", [("a", "b"), ("é", "z"), ("TgER", "CYet")])
def test_words_made_of_repeated_parts_are_told_apart(spark, a, b):
    """Long words whose polynomials agree are no hit (op3) and no link (op6)."""
    one, other = alternating(10, a, b)
    head = "one two three four five six seven eight nine "
    docs = spark.createDataFrame([(1, head + one), (2, head + other), (3, one), (4, other)], "doc_id long, text string")
    items = spark.createDataFrame([("x", head + one)], "item_id string, text string")
    got = {r.id: (r.n_hit, r.contaminated) for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: (10, True), 2: (0, False), 3: (0, False), 4: (0, False)}
    alone = docs.filter("doc_id > 2")
    assert all(r.n_links == 0 and r.kept for r in neardup.near_duplicates(alone).collect())


def test_hash_proposes_and_words_decide(spark, monkeypatch):
    """With a hash of 4 bits nearly everything collides; the result stays."""
    from supplyscope.llm import textscan
    whole = textscan.Words.gram
    monkeypatch.setattr(textscan.Words, "gram", staticmethod(lambda word, k: whole(word, k) & np.uint64(15)))
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["a", "b", "c"], n)) for n in rng.integers(0, 60, 60)]
    items = [(f"i{k}", " ".join(rng.choice(["a", "b", "c"], n))) for k, n in enumerate((3, 10, 12, 25, 7, 10, 40, 0))]
    block = decontaminate.Items([i for i, _ in items], [t for _, t in items])
    got = [(n, int(mask.sum()), len(set(names)), brute.sha(",".join(sorted(set(names)))), bool(mask.any()))
           for n, mask, names in decontaminate.scan(block, pa.array(texts))]
    assert got == [x[1:] for x in brute.contamination(list(enumerate(texts)), items)]


def test_words_hash_each_word_alike_wherever_it_stands():
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abé0"), n)) for n in (1, 2, 7, 8, 9, 15, 16, 17, 24, 25, 255, 256, 257, 300) for _ in range(40)]
    from supplyscope.llm.textscan import Words
    from supplyscope.llm.work import byte_view
    order = rng.permutation(len(words))
    a = Words(*byte_view(pa.array([" ".join(words)]))).hash
    b = Words(*byte_view(pa.array([words[i] for i in order]))).hash
    assert (a[order] == b).all()
    assert len(set(a.tolist())) == len(set(words))


def passages(lengths, seed):
    """Documents of unlike words with a passage of n words twice, for each n;
    their words have 3 to 8 letters."""
    rng = np.random.default_rng(seed)
    def word():
        return "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(3, 9)))
    docs = []
    for n in lengths:
        shared = " ".join(word() for _ in range(n))
        docs += [" ".join([*(word() for _ in range(30)), shared, *(word() for _ in range(30))]) for _ in range(2)]
        docs.append(" ".join(word() for _ in range(90)))
    return docs


def test_repeats_of_planted_passages(spark):
    """Passages of 51 to 120 words on both sides of 400 bytes: those of 400 or
    more go, byte for byte as a plain version says, shorter ones stay."""
    docs = list(enumerate(passages(range(51, 121, 3), 8)))
    out = repeats.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out)
    want = sorted(brute.repeats(docs))
    assert got == want
    removed = {d: n for d, _, n, _, _ in want}
    assert any(removed[3 * k] for k in range(24)) and any(not removed[3 * k] for k in range(24))
    assert not any(removed[3 * k + 2] for k in range(24))


def test_repeats_of_texts_alike_in_every_power_of_an_odd_base(spark, pairs):
    """Two words in Thue-Morse order and in the opposite one: polynomials
    modulo 2^64 can't tell these 400 bytes apart, and none is repeated."""
    order = [i.bit_count() & 1 for i in range(64)]
    one, two = ("abcd" * 36 + "".join(("TgER", "CYet")[k ^ flip] for k in order) for flip in (0, 1))
    texts = [one, two, one[:300] + "x" * 200, two[:300] + "y" * 200, "é" * 90]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.n_removed for r in repeats.remove_repeats(df).collect()] == [0] * 5
    check_repeats(df.repartition(3), pairs)


def test_fingerprints_are_polynomials_of_the_window():
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.integers(0, 256, 2 * repeats.BLOCK), np.full(900, 255), np.zeros(500)]).astype(np.uint8)
    start = np.array([0, 5, repeats.BLOCK - 1, repeats.BLOCK, 2 * repeats.BLOCK - 1, 2 * repeats.BLOCK + 7, len(data) - 400])
    for key, factor in (*repeats.drawn_keys(), (repeats.PRIME - 1, repeats.PRIME - 2)):
        got = repeats.Fingerprints(key, factor, 400).at(data, start, 400)
        want = [factor * sum((int(c) + 1) * pow(key, i, repeats.PRIME) for i, c in enumerate(data[s:s + 400])) % repeats.PRIME
                for s in start]
        assert got.tolist() == want
