"""Secret scans against the patterns read plainly, and the token test on strings of known kinds."""

import hashlib
import random
import re
import string

import pytest

from ledgerspark.llm import queries, secret_scan

DOCS = "doc_id long, text string, lang string, source string, n_chars long, spans string"
PLAIN = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
]


def plain(text):
    found = []
    for order, (kind, pattern, group, least) in enumerate(PLAIN):
        flags = re.ASCII | (re.IGNORECASE if kind == "assign" else 0)
        found += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
    return [s for _, _, s in sorted(found)]


@pytest.fixture(scope="module")
def encoding():
    return secret_scan.vocabulary(queries.ranks_path(), queries.RANKS_PATTERN)


def rows_of(spark, texts):
    docs = spark.createDataFrame([(i, t, None, None, None, "mine") for i, t in enumerate(texts)], DOCS)
    return secret_scan.span_digests(secret_scan.find_secrets(docs, queries.ranks_path(), queries.RANKS_PATTERN))


def test_base_matches_equal_the_patterns(spark, encoding):
    rng = random.Random(6)
    pieces = ["password", "PassWD", "secret", "api_key", "APIKEY", "token", "\u017fecret", "to\u212aen", '"', "'", " ", ":", "=", "AKIA", "é", "😀", "\n"]
    runs = ["0123456789abcdef", "ABCDEF1234567890", "a1/b2+c3_d4.e5=", "x", "deadbeef"]
    texts = ["".join(rng.choices(pieces, k=3)) + "".join(rng.choices(pieces + runs * 3, k=rng.randint(0, 25))) for _ in range(600)]
    texts += ["token: secret = abcdefghijklmnop", "AKIAKIA0123456789AB", "x" * 100_000 + " token=abcdefabcdef", ""]
    found = {r.doc_id: r for r in rows_of(spark, texts).collect()}
    hits = 0
    for i, text in enumerate(texts):
        base, own = plain(text), found[i]
        assert own.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [s for s in own.spans.split(",") if s and not s.startswith("random")] == base
        assert [own.n_assign, own.n_access, own.n_hex] == [sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex")]
        hits += len(base)
    assert hits > 300


def test_random_strings_are_found_and_known_forms_are_not(encoding):
    rng = random.Random(7)
    alphabets = [string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_uppercase + string.digits, string.ascii_lowercase]
    for alphabet in alphabets:
        keys = ["".join(rng.choices(alphabet, k=rng.randint(24, 64))) for _ in range(300)]
        caught = [k for k in keys if any(s[0] == "random" for s in secret_scan.spans(f"the key is {k}.", encoding))]
        assert len(caught) >= 0.98 * len(keys)
    for known in (
        "550e8400-e29b-41d4-a716-446655440000", "D41D8CD98F00B204E9800998ECF8427E", "get_user_account_by_identifier", "getUserAccountByIdentifier",
        "2023-01-15T12-30-45Z_000001", "12345678901234567890123", "some/path/to/a/file-name", "=" * 40, "-" * 25, "Donaudampfschifffahrtsgesellschaft",
        "internationalization", "CONSTANT_VALUE_FOR_MAXIMUM",
    ):
        assert not any(s[0] == "random" for s in secret_scan.spans(f"see {known} here", encoding)), known


def test_random_spans_lie_apart_from_base_ones(encoding):
    key = "Zk3vQ9xT7bLm2NcR8wYp4HsD"
    text = f"😀 token = {key} and {key}"
    found = secret_scan.spans(text, encoding)
    assert [k for k, _, _ in found] == ["assign", "random"]
    assert [text[a:b] for _, a, b in found] == [f"token = {key}", key]


def test_odd_rows(spark, encoding):
    long = "word " * 40_000 + "Zk3vQ9xT7bLm2NcR8wYp4HsD" + "q" * 200_000
    docs = spark.createDataFrame([(1, None, None, None, None, None), (None, "", None, None, None, None), (2, long, None, None, None, None)] * 2 + [(9007199254740993, "x", None, None, None, None)], DOCS)
    scanned = secret_scan.find_secrets(docs, queries.ranks_path(), queries.RANKS_PATTERN)
    found = secret_scan.span_digests(scanned).collect()
    assert sorted((r.doc_id or 0) for r in found) == [0, 0, 1, 1, 2, 2, 9007199254740993]
    assert {r.base_sha256 for r in found} == {hashlib.sha256(b"").hexdigest()}
    assert all((r.spans != "") == (r.doc_id == 2) for r in found)
    assert scanned.limit(0).count() == 0 and secret_scan.find_secrets(docs.limit(0), queries.ranks_path(), queries.RANKS_PATTERN).count() == 0


def test_query_equals_the_patterns(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    found = queries.op13_secret_scan(spark, folder).collect()
    assert {r.doc_id: r.base_sha256 for r in found} == {i: hashlib.sha256(",".join(plain(t)).encode()).hexdigest() for i, t in texts.items()}
    assert len(found) == len(texts)
