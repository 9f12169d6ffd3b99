"""Personal data: spans against plain regular expressions, edge cases, redaction."""

import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from freqscope.llm import pii

SF_SMALL = "/root/testdata/sf0.001"

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn_slow(d):
    total = 0
    for k, x in enumerate(map(int, reversed(d))):
        x = x * 2 if k % 2 else x
        total += x // 10 + x % 10
    return total % 10 == 0


def brute(text):
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and luhn_slow(digits(m[0]))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.BASE_KINDS.index(s[0])))


def base(text):
    return [s[:3] for s in pii.spans_of(text) if s[0] in pii.BASE_KINDS]


PIECES = ["a.b+c@x.org", "@", "a@b", "x@y.z@q.w", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111",
          "4111-1111-1111-1112", "5500000000000004", "+1 (555) 010-9999", "+44 20 7946 0958", "+", "+1", " ", ".", "-",
          "é", "漢", "\U0001F600", "\n", "007.008.009.010", "12", "x_y", "DE89 3704 0044 0532 0130 00"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14))
def test_base_spans_equal_plain_patterns(parts):
    text = "".join(parts)
    assert base(text) == brute(text)


def test_long_runs_take_linear_time():
    for text in ("9" * 60_000, "a" * 60_000, "1." * 30_000, "a@" * 30_000, "+1" + " " * 60_000, "1 " * 40_000):
        base(text)


def test_added_kinds_need_their_checks():
    kinds = lambda t: [s[0] for s in pii.spans_of(t)]
    assert "iban" in kinds("pay to DE89 3704 0044 0532 0130 00 now")
    assert "iban" not in kinds("pay to DE88 3704 0044 0532 0130 00 now")
    assert "ssn" in kinds("social security 123-45-6789") and "ssn" not in kinds("part 123-45-6789")
    assert "secret" in kinds('token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"')
    assert pii.spans_of("card 4111111111111111")[0][3] > pii.spans_of("thing 4111111111111111")[0][3]


def test_redaction_merges_overlaps():
    assert pii.redact_text("to a@b.co, 4111 1111 1111 1111.") == "to [EMAIL], [CARD]."
    assert pii.redact_text("") == "" and pii.redact_text("nothing") == "nothing"
    for s in pii.spans_of(pii.redact_text("x +1 (555) 010-9999 y 1.2.3.4 z")):
        raise AssertionError(s)


def test_query_columns_and_edge_rows(spark, tmp_path):
    rows = [(1, "é a@b.co"), (1, "é a@b.co"), (2, None), (3, ""), (None, "4111111111111111"), (4, "x" * 300_000 + " 1.2.3.4")]
    df = spark.createDataFrame([(a, b, "s", 7) for a, b in rows], "doc_id long, text string, spans string, kind int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = pii.op1_pii(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["spans"] == "email:2:8" and by[1]["n_email"] == 1
    assert by[1]["base_sha256"] == hashlib.sha256(b"email:2:8").hexdigest()
    assert by[2]["spans"] == "" and by[2]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert by[None]["n_card"] == 1 and by[4]["n_ip"] == 1
    empty = df.limit(0)
    assert pii.find_pii(empty).count() == 0 and pii.redact(empty).columns == df.columns
    assert [r["text"] for r in pii.redact(df.where("doc_id = 2")).collect()] == [None]


def test_all_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in pii.op1_pii(spark, SF_SMALL).collect():
        want = brute(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert r["n_phone"] == sum(k == "phone" for k, _, _ in want)
