import hashlib
import random
import re

from helixframe.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 14 <= len(d := re.sub("[ -]", "", m.group())) <= 19 and pii.luhn(d)]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(re.findall("[0-9]", m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.BASE_KINDS.index(s[0])))


def test_base_spans_equal_plain_expressions():
    rng = random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choice("a@.-1 2+%(é_9)4") for _ in range(rng.randint(0, 60)))
        assert [s[:3] for s in pii.scored(text) if s[0] in pii.BASE_KINDS] == plain(text), text


def test_validators_and_context():
    kinds = lambda t: [s[0] for s in pii.scored(t)]
    assert kinds("IBAN DE89 3704 0044 0532 0130 00 now") == ["iban"]
    assert kinds("IBAN DE88 3704 0044 0532 0130 00 now") == []
    assert kinds("call 555-123-4567") == ["national_phone"] and kinds("see 555-123-4567") == []
    assert pii.luhn("4041894974608795") and not pii.luhn("4041894974608796")


def test_ibans_behind_ibans_and_failed_matches():
    spans = lambda t: [t[a:z] for k, a, z, _ in pii.scored(t) if k == "iban"]
    german, british, norwegian = "DE89370400440532013000", "GB29NWBK60161331926819", "NO9386011117947"
    assert spans(f"{german} {british}") == [german, british]
    assert spans(f"NR12 DE89 3704 0044 0532 0130 00 {norwegian}") == ["DE89 3704 0044 0532 0130 00", norwegian]
    assert spans(f"DE88370400440532013000 {british} x{german}") == [british]
    assert pii.redact_text(f"{german} {british}.") == "[IBAN] [IBAN]."
    assert spans("NR12 " * 60_000 + german) == [german]


def test_long_runs_stay_linear():
    assert pii.scored("a" * 300_000 + " " + "1" * 300_000 + "." * 1000 + "@" * 1000) == []


def test_query_and_redaction(spark, tmp_path):
    rows = [(1, "mail x@y.com or 10.0.0.1", "s", 7), (2, None, None, 7), (3, "", "s", 7), (4, "ü 4041894974608795", "s", 7), (4, "ü 4041894974608795", "s", 7), (None, "+1 (988) 555-2485", "s", 7)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, pii int").write.parquet(f"{tmp_path}/documents.parquet")
    got = pii.op2_pii(spark, str(tmp_path)).collect()
    assert len(got) == 6
    for r in got:
        text = next(x[1] for x in rows if x[0] == r["doc_id"]) or ""
        want = ",".join(f"{k}:{a}:{b}" for k, a, b in plain(text))
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest() and r["spans"] == want
        assert r["n_email"] == want.count("email") and r["n_ip"] == want.count("ip")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()}[1] == "mail [EMAIL] or [IP]"
    assert pii.find_pii(docs.limit(0), out_col="found").count() == 0
