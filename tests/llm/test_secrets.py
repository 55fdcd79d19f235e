"""Secret spans: base patterns by a plain reading, novelty by planted keys."""

import hashlib
import random
import re

from tessera.llm import secrets as sc
from tests.conftest import SF001

NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
VALUE = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


def plain_assign(text):
    """The assignment pattern read character by character."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    out, at = [], 0
    while at < len(text):
        name = next((n for n in NAMES if low.startswith(n, at)), None)
        i = at + len(name) if name else None
        if name:
            i += text[i:i + 1] in ('"', "'") and text[i:i + 1] != ""
            while text[i:i + 1] == " ":
                i += 1
            if text[i:i + 1] in (":", "=") and text[i:i + 1]:
                i += 1
                while text[i:i + 1] == " ":
                    i += 1
                i += text[i:i + 1] in ('"', "'") and text[i:i + 1] != ""
                end = i
                while end < len(text) and text[end] in VALUE:
                    end += 1
                if end > i:
                    if end - i >= 8:
                        out.append((at, 0, end))
                    at = end
                    continue
        at += 1
    return out


def brute_base(text):
    return sorted(plain_assign(text) + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
                  + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32])


def digest(spans):
    return ",".join(f"{sc.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_documents(spark):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    got = {r.doc_id: r for r in sc.scan(df).collect()}
    for r in df.collect():
        base = brute_base(r.text or "")
        g = got[r.doc_id]
        assert (g.n_assign, g.n_access, g.n_hex) == tuple(sum(k == n for _, k, _ in base) for n in range(3))
        assert g.base_sha256 == hashlib.sha256(digest(base).encode()).hexdigest()
        assert set(digest(base).split(",")) - {""} <= set(g.spans.split(","))


def test_base_on_random_text():
    rng = random.Random(7)
    parts = ["password", "Token", "SECRET", "api_key", "apiKEY", "paſswd", "toKen", "=", ":", '"', "'", " ", "  ", "abc", "x" * 8, "A/b+c=d.e-f_",
             "AKIA", "AKIAABCD1234EFGH", "Z9", "0123456789abcdef", "deadbeef" * 4, "é", "\n", "short", "😀"]
    for _ in range(6000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 14)))
        assert sorted(sc.base_spans(text)) == brute_base(text), text


def test_novelty():
    rng = random.Random(1)
    key = lambda n: "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=n))
    for n in (20, 32, 64):
        k = "a1B2" + key(n)
        for text in (f"Authorization: Bearer {k}\n", f"the private key is {k} and so on", f"credential -> '{k}'"):
            _, spans = sc.all_spans(text)
            assert [(text[s:e], sc.KINDS[kind]) for s, kind, e in spans] == [(k, "novel")]
    for text in ("see section 12 of the secretariat_report_2024_final about it",
                 "the key default_connection_string_01 default_connection_string_01 is a name",
                 f"no context here {key(40)}", "authentication_credentials_example_config_1", "token tokenization_of_the_example_1"):
        assert sc.all_spans(text)[1] == [], text


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "password=abcdefgh1"), (3, "password=abcdefgh1"), (None, "x" * 300000 + "AKIAABCDEFGH123456"),
            (4, "token: abcdefgh token=deadbeefdeadbeefdeadbeefdeadbeef1")]
    df = spark.createDataFrame([(*r, "s", 5) for r in rows], "doc_id long, text string, spans string, n_chars int")
    got = [(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.spans) for r in sc.scan(df).collect()]
    assert sorted(got, key=str) == sorted([
        (1, 0, 0, 0, ""), (2, 0, 0, 0, ""), (3, 1, 0, 0, "assign:0:18"), (3, 1, 0, 0, "assign:0:18"),
        (None, 0, 1, 0, "access:300000:300018"), (4, 2, 0, 1, "assign:0:15,assign:16:55,hex:22:55")], key=str)
    out = sc.redact(df)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    text = {(r.doc_id, r.text if r.text is None or len(r.text) < 99 else r.text[-9:]): r.n_chars for r in out.collect()}
    assert text == {(1, None): 5, (2, ""): 0, (3, "[SECRET]"): 8, (None, "x[SECRET]"): 300008, (4, "[SECRET] [SECRET]"): 17}
    assert sc.scan(df.limit(0)).count() == 0 and sc.redact(df.limit(0)).count() == 0


def test_novelty_of_any_alphabet():
    """Random strings of few digits, of small alphabets at any length, and at the end of the reach."""
    rng = random.Random(21)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = lambda text: [(text[s:e], sc.KINDS[kind]) for s, kind, e in sc.all_spans(text)[1]]
    for abc in (upper, upper.lower(), upper + "234567", "0123456789ABCDEF", "0123456789", upper + upper.lower() + "0123456789+/"):
        for n in (16, 17, 20, 33, 64, 120, 300, 1000):
            for _ in range(12):
                k = "".join(rng.choices(abc, k=n))
                kind = "hex" if abc.isdigit() and n >= 32 else "novel"  # long digits are a base span
                assert found(f"Authorization: Bearer {k}\n") == [(k, kind)], (n, k)
    k = "".join(rng.choices(upper + "0123456789", k=24))
    for gap in range(1, sc.REACH):
        assert found("credential" + " " * gap + k) == [(k, "novel")], gap
    assert found("credential" + " " * sc.REACH + k) == []
    for text in ("bearer " + "-" * 40, "bearer " + "=" * 16, "bearer " + "x" * 300, "token default_connection_string_config"):
        assert found(text) == [], text


def test_every_separator_between_name_and_key():
    rng = random.Random(11)
    abc = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    found = lambda text, **kw: [text[s:e] for s, kind, e in sc.all_spans(text, **kw)[1] if kind == 3]
    names = ("private_key", "credential", "bearer", "authorization", "signature", "passphrase", "access_key", "pwd", "client_id", "auth",
             "aws_secret_access_key", "access_key_id", "Secret-Access-Key-For-The-Service")
    for name in names:
        for sep in ("=", " = ", ":", ": ", '="', "='", "=>", " -> ", "\t", "|", ",", "=="):
            for _ in range(3):
                k = "".join(rng.choices(abc, k=32))
                assert found(f"x {name}{sep}{k} y") == [k], (name, sep, k)
    for sep in "-/+_":
        for name in ("token", "bearer", "credential"):
            k = "".join(rng.choices(abc, k=30)) + "42"
            assert found(f"x {name}{sep}{k} y") == [k], (name, sep)
    k = "".join(rng.choices(abc, k=30)) + "=="
    assert found(f"credential={k}&x") == [k]                      # padding belongs to the key
    assert found("the token-based-default-connection-config of it") == []
    far = f"credential {'. ' * 100}{k}"
    assert found(far) == [] and found(far, reach=400) == [k]


def test_precision_and_recall_on_planted_strings():
    """Long words and identifiers near a sensitive name are none, random keys are."""
    rng = random.Random(5)
    found = lambda text: [text[s:e] for s, kind, e in sc.all_spans(text)[1] if kind == 3]
    plain = ("internationalization telecommunications responsibilities chocolatechipcookies docs/reference/authentication/overview "
             "well-known-configuration two-factor-authentication self-service-registration InternationalOrganization "
             "AUTHENTICATION_REQUIRED_NOW getUserAccountPreferences release_notes_2024_11 customer-support/opening-hours").split()
    for word in plain:
        for text in (f"the token {word} is described here", f"authorization: {word}\n", f"credential='{word}'"):
            assert found(text) == [], text
    words = sorted(w for w in sc._vocabulary(sc.vocabulary_path()) if len(w) >= 6)
    reported = 0
    for _ in range(600):
        word = rng.choice("-_/").join(rng.sample(words, 3))
        if rng.random() < 0.3:
            word = "".join(w.title() for w in rng.sample(words, 3))
        reported += found(f"the bearer {word} of it") != []
    assert reported <= 6, reported
    missed = 0
    for abc in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEF",
                "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"):
        for n in (16, 24, 32, 64, 200):
            for _ in range(40):
                k = "".join(rng.choices(abc, k=n - 1)) + rng.choice(abc.strip("+/"))
                missed += found(f"Authorization: Bearer {k}\n") != [k]
    assert missed <= 4, missed


def test_words_of_a_candidate(tmp_path):
    own = tmp_path / "words.json"
    own.write_text('{"model": {"vocab": {"alpha</w>": 0, "alphabet": 1, "soup</w>": 2, "ab": 3, "naïve": 4}}}')
    assert sc.spelled_with("AlphabetSoup_alphaALPHA-alphabetsoupab", str(own)) == [
        "Alphabet", "Soup", "alpha", "ALPHA", "alphabet", "soup"]
    assert sc.spelled_with("aLpHa4242naïve", str(own)) == [] == sc.spelled_with("", str(own))
