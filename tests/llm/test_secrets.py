"""Secret scan against a plain Python matcher, and its edge cases."""

import hashlib
import random
import re
import string

from tidemark.llm import secrets as S

PATTERNS = {
    "assign": (re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}


def brute(text):
    found = []
    for k, (kind, (pat, group, least)) in enumerate(PATTERNS.items()):
        found += [(m.start(), k, m.end(), kind) for m in pat.finditer(text or "") if len(m[group]) >= least]
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


def test_base_spans_equal_a_plain_matcher(spark):
    rnd = random.Random(5)
    rows = [(0, None), (1, ""), (2, "token: token: abcdefgh"), (3, "é€😀 AKIA" + "A1" * 8 + " 😀 password='hunter2x'"),
            (4, "x" * 5000 + "0123456789abcdef" * 2), (5, "api_key==abcdef api-key=abcdefg PASSWD : q1w2e3"),
            (6, "a" * 24 + "g" + "f" * 23), (7, "Secret=\"0123456789abcdef0123456789abcdef\"")]
    bits = ["token", "secret", ":", "=", " ", "'", "AKIA", "AKIAQ", "deadbeef" * 3, "é", "abc", "12345678", "\n", "Z9" * 9]
    rows += [(10 + i, "".join(rnd.choice(bits) for _ in range(40))) for i in range(200)]
    rows += [(9, "repeat token=abcdef")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in S.scan(df).collect()}
    assert S.scan(df).count() == len(rows)
    for i, text in rows:
        want, r = brute(text), got[i]
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (i, text, want, r["spans"])
        assert [x for x in r["spans"].split(",") if x and not x.startswith("random")] == [x for x in want.split(",") if x]
        assert r["n_assign"] + r["n_access"] + r["n_hex"] == len([x for x in want.split(",") if x])


def test_battery_keeps_random_and_drops_structured(spark):
    rnd = random.Random(7)
    b64 = string.ascii_letters + string.digits + "+/"
    keys = ["".join(rnd.choice(b64) for _ in range(rnd.choice([32, 40, 64]))) for _ in range(60)]
    plain = ["Aa1" * 14, "AAAAbbbb11112222CCCCdddd33334444", "ThisIsALongCamelCaseIdentifier2Handler", "a" * 20 + "B" * 20 + "1" * 4] * 15
    rows = [(i, f"see {t} here") for i, t in enumerate(keys + plain)]
    got = {r["doc_id"]: r["n_random"] for r in S.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[i] for i in range(60)) >= 54
    assert sum(got[i] for i in range(60, 120)) <= 3


def test_redaction_and_clashing_columns(spark):
    rows = [(1, "a password=abcdef1 b", 20, "k"), (2, None, None, "l"), (3, "clean", 5, "m"),
            (4, "secret=" + "0123456789abcdef" * 2, 39, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans string")
    out = {r["doc_id"]: r for r in S.redact(df).collect()}
    assert out[1]["text"] == "a [SECRET] b" and out[1]["n_chars"] == 12 and out[1]["spans"] == "k"
    assert out[2]["text"] is None and out[3]["text"] == "clean" and out[4]["text"] == "[SECRET]"
    assert S.scan(df.limit(0)).count() == 0 and S.redact(df).columns == df.columns


def test_no_python_on_the_path(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = S.scan(df)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
