"""PII, token counts, secrets and decontamination against plain versions."""

import base64
import json
import random
import struct

import brute
import pytest

from supplyscope.llm import decontaminate, pii, secrets, tokens
from supplyscope.llm.queries import tokenizer_model


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


TRICKY = [
    "a@b.c_d@e.f mail x@@y.z a@b@c.d. Contact: bob.smith@mail.example.com!", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.04 255.255.255.255",
    "4785380592391139 and 4785 3805 9239 1139 or 4785-3805--9239 1139, é 49927398716", "+1 (234) 567-8901 +12 ++49 30 1234567 call +4930((((",
    "IBAN GB82 WEST 1234 5698 7654 32 and GB82WEST12345698765433", "9" * 5000 + " " + "a" * 20000 + "@", "+1" + "(" * 3000,
    "é😀 a@b.co 😀 10.0.0.1", "1 2  3", "",
]


def check_pii(df):
    got = pii.pii_spans(df).collect()
    want = sorted(brute.sha(",".join(brute.pii(t))) for t in [r.text for r in df.select("text").collect()])
    assert sorted(r.base_sha256 for r in got) == want


def test_pii_matches_plain_patterns(spark, small, odd_docs):
    check_pii(small)
    check_pii(odd_docs)
    check_pii(spark.createDataFrame([(i, t) for i, t in enumerate(TRICKY)], "doc_id long, text string"))


def test_pii_confirms_accounts_and_scores_context(spark):
    df = spark.createDataFrame([(0, TRICKY[4]), (1, "call +1 234 567 8901"), (2, "xyz +1 234 567 8901")], "doc_id long, text string")
    a, b, c = sorted(pii.pii_spans(df).collect(), key=lambda r: r.doc_id)
    assert (a.n_iban, a.spans) == (1, "iban:5:32")
    assert b.scored.endswith(":0.7") and c.scored.endswith(":0.5")
    assert "BatchEvalPython" not in pii.pii_spans(df)._jdf.queryExecution().toString()


def account(country, rest):
    """An account number with the right check digits."""
    turned = "".join(str(int(c, 36)) for c in rest + country)
    return f"{country}{98 - int(turned + '00') % 97:02}{rest}"


def test_pii_accounts_before_other_words(spark):
    de, spaced, gb, other = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", account("QQ", "1234567890ABCDE")
    cases = [("IBAN ", [de], " Please pay"), ("", [spaced], " Bank"), ("IBAN ", [de], " BIC COBADEFF"), ("", [de, gb], " AND 12 MORE"),
             ("", [spaced, spaced, de], " 3000"), ("X ", [other], " Z"), ("to ", [other], ""), ("ab ", [gb], ", " + de[:-1] + "1"),
             ("é😀 ", [de], "\n"), ("AB12 ", [spaced], " X"), ("", [account("MT", "MALT01100" + "0012345MTLCAST001S")], " Next"),
             ("", [account("GB", "AB12" + "34567890123456")[:4] + " AB12 3456 7890 1234 56"], " DE"), ("xx", [], de), ("", [], de + "x"),
             ("", [], de[:-1] + " 0 Q"), ("IBAN " + "AB12 " * 3000, [de], " Please")]
    texts, want = [], []
    for before, numbers, after in cases:
        at, spans = len(before), []
        for n in numbers:
            spans.append(f"iban:{at}:{at + len(n)}")
            at += len(n) + 1
        texts.append(before + " ".join(numbers) + after)
        want.append(spans)
    want[-2] = [f"iban:0:{len(cases[-2][2]) - 2}"]
    got = pii.pii_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r.doc_id: ([x for x in r.spans.split(",") if x.startswith("iban")], r.n_iban) for r in got}
    assert got == {i: (w, len(w)) for i, w in enumerate(want)}


def test_pii_account_context_is_not_another_number(spark):
    text = "IBAN GB82 WEST 1234 5698 7654 32 or so DE89370400440532013000"
    r = pii.pii_spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r.scored == "iban:5:32:1.0,iban:39:61:0.9"


def test_pii_empty(no_docs):
    assert pii.pii_spans(no_docs).collect() == []


@pytest.fixture(scope="module")
def model():
    return tokenizer_model()


def check_tokens(df, model, **kw):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    want = [(r.doc_id, len((r.text or "").encode()), n, n > 4096) for r, n in
            ((r, len(sp.encode(r.text or ""))) for r in df.select("doc_id", "text").collect())]
    assert rows(tokens.token_counts(df, model, **kw)) == sorted(map(str, want))


def test_tokens_match_library(spark, small, odd_docs, model):
    check_tokens(small, model)
    check_tokens(odd_docs, model)
    texts = ["a b", "a  b", " a", "a ", "  ", "a▁ b", "a ▁b", "a\n b\t c", "<s>x</s> <unk>", "x" * 5000, "é é", "a　b c", "  a  "]
    check_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)


def test_tokens_split_long_texts_safely(spark, model):
    texts = ["word  two three\n" * 500, "a" * 3000 + " b", " " * 700 + "end", "no.space" * 400]
    check_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, batch_bytes=100)


def test_tokens_empty(no_docs, model):
    assert tokens.token_counts(no_docs, model).collect() == []


def test_secrets_match_plain_patterns(spark, small, odd_docs):
    more = ["Token: abc token='abcdef' PASSWD = \"x1y2z3\" api-key=123456 ApiKey:secret=abcdefgh", "AKIA" + "A" * 16 + " AKIAAKIA",
            "f" * 23 + " " + "0a" * 12, "ſecret=abcdefg toKen=abcdef"]
    for df in (small, odd_docs, spark.createDataFrame(list(enumerate(more)), "doc_id long, text string")):
        want = sorted(brute.sha(",".join(brute.secrets(r.text))) for r in df.select("text").collect())
        assert sorted(r.base_sha256 for r in secrets.secret_spans(df).collect()) == want


def b64url(b):
    return base64.urlsafe_b64encode(b).decode().rstrip("=")


def test_secrets_confirm_structure(spark):
    integer = b"\x02\x10" + b"\x11" * 16
    der = b"\x30" + bytes([3 * len(integer)]) + integer * 3
    ssh = b"".join(struct.pack(">I", len(x)) + x for x in (b"ssh-rsa", b"\1\0\1", b"\7" * 64))
    jwt = b64url(json.dumps({"alg": "HS256"}).encode()) + "." + b64url(json.dumps({"sub": 1}).encode()) + ".c2ln"
    fake = b64url(b'{"no": "header here"}') + "." + b64url(b'{"a": 1}') + ".c2ln"
    texts = [f"key {base64.b64encode(der).decode()} end", f"ssh-rsa {base64.b64encode(ssh).decode()}", f"bearer {jwt}", f"bearer {fake}",
             base64.b64encode(b"\x30\x7f" + b"x" * 60).decode(), der.hex(), "A" * 80,
             "-----BEGIN RSA PRIVATE KEY-----\n" + base64.encodebytes(der).decode() + "-----END RSA PRIVATE KEY-----"]
    got = secrets.secret_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    kinds = {r.doc_id: [s.split(":")[0] for s in r.spans.split(",") if s] for r in got}
    assert {k: [x for x in v if x in ("der", "ssh", "jwt")] for k, v in kinds.items()} == {
        0: ["der"], 1: ["ssh"], 2: ["jwt"], 3: [], 4: [], 5: ["der"], 6: [], 7: ["der"]}


def test_secrets_confirm_escaped_and_joined_keys(spark):
    rng = random.Random(7)
    integer = b"\x02\x40" + b"\x11" + rng.randbytes(63)
    der = b"\x30\x82" + (5 * len(integer)).to_bytes(2, "big") + integer * 5
    short = b"\x30\x24" + (b"\x02\x10" + b"\x21" * 16) * 2
    wire = b"".join(struct.pack(">I", len(x)) + x for x in (b"ssh-ed25519", b"\7" * 32))
    openssh = b"openssh-key-v1\0" + b"\0\0\0\4none" * 9
    lines = base64.encodebytes(der).decode().split()
    pem = lambda eol: "-----BEGIN PRIVATE KEY-----" + eol + eol.join(lines) + eol + "-----END PRIVATE KEY-----"
    key, small, ssh, new = (base64.b64encode(x).decode() for x in (der, short, wire, openssh))
    url = base64.urlsafe_b64encode(der).decode().rstrip("=")
    cases = [('{"k": "', pem("\\n"), '"}', "der"), ('K="', pem("\\r\\n"), '"', "der"), ("x ", pem("\\\\n"), "", "der"),
             ("", pem("\\n").replace("/", "\\/"), "", "der"), ("private_key_", key, " end", "der"), ("/etc/keys/", key, "", "der"),
             ("a-b-", url, "_more-words", "der"), *(("MY/", small.rstrip("="), "-" * n, "der") for n in range(1, 6)), ("x=MIMIMI_", small, "", "der"), ("MY_", ssh, "", "ssh"), ("n", new, " ", "ssh"),
             ("key_", der.hex(), "_", "der"), ("é😀 \\n", key, "", "der")]
    df = spark.createDataFrame([(i, a + b + c) for i, (a, b, c, _) in enumerate(cases)], "doc_id long, text string")
    for r in secrets.secret_spans(df).collect():
        a, b, _, kind = cases[r.doc_id]
        assert [x for x in r.spans.split(",") if x.split(":")[0] in ("der", "ssh")] == [f"{kind}:{len(a)}:{len(a) + len(b)}"], cases[r.doc_id]
        assert r.n_confirmed == 1


def test_secrets_of_noise_have_no_keys():
    rng = random.Random(5)
    texts = [base64.b64encode(rng.randbytes(200_000)).decode(), "MI" * 100_000, "AAAA" * 50_000, "3080" * 50_000, "b3BlbnNzaA" * 1000,
             "-----BEGIN X-----" + "\\" * 50_000, "MIIE" * 50_000,
             "x_" + "30" * 20 + "3_"]
    assert [secrets.confirmed_spans(t, t.encode()) for t in texts] == [[]] * len(texts)


def test_secrets_empty(no_docs):
    assert secrets.secret_spans(no_docs).collect() == []


def check_contamination(docs, bench, pairs, **kw):
    items = [(r.item_id, r.text) for r in bench.collect()]
    got = decontaminate.contamination(docs, bench, **kw)
    assert rows(got.select("id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")) == sorted(
        map(str, brute.contamination(pairs(docs), items)))


def test_contamination_matches_plain_search(spark, small, sf_small, odd_docs, pairs):
    bench = spark.read.parquet(f"{sf_small}/benchmark.parquet")
    check_contamination(small, bench, pairs)
    odd = spark.createDataFrame([(1, "words here five"), (2, None), (3, ""), (4, "w5x5 w6x6 w7x7 w8x8 w9x9 w10x10 w11x11 w12x12 w13x13 w14x14 w15x15"),
                                 (4, "é"), (5, "w900x1")], "item_id long, text string")
    check_contamination(odd_docs, odd, pairs)
    # several blocks of items give the same
    check_contamination(odd_docs, odd, pairs, block_bytes=30)


def test_contamination_empty(spark, no_docs, odd_docs):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.contamination(no_docs, bench).collect() == []
    assert all(not r.contaminated for r in decontaminate.contamination(odd_docs, bench.limit(0)).collect())
