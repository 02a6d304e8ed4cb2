import random
import re

import pytest
from pyspark.sql import functions as F

from tracelode.functions.redact import (
    PERSONAL_RULES,
    SECRET_RULES,
    hits,
    is_flagged,
    matched_rules,
    redact,
    will_be_flagged,
)

PEM = "-----BEGIN {0}PRIVATE KEY-----\nMIIE\nabc\n-----END {0}PRIVATE KEY-----"

CASES = [
    ("use AKIA" + "A" * 16 + " now", "use [REDACTED_AWS_KEY] now", "A" * 16),
    ("ASIA" + "B" * 16, "[REDACTED_AWS_TEMP_KEY]", "B" * 16),
    ("eyJa1.eyJb2.c3", "[REDACTED_JWT_TOKEN]", "eyJb2"),
    ('password="hunter2"', "password=[REDACTED_CREDENTIAL]", "hunter2"),
    ("API_KEY : 'abc'", "API_KEY : [REDACTED_CREDENTIAL]", "'abc'"),
    ('token = "24bead"', "token = [REDACTED_CREDENTIAL]", "24bead"),
    ("https://u:p@host/x", "[REDACTED_URL_CREDS]", "u:p"),
    ("see http://a.com/x then note: mail bob@x.y now", "see http://a.com/x then note: mail bob@x.y now", None),
    (PEM.format("RSA "), "[REDACTED_PRIVATE_KEY]", "MIIE"),
    (PEM.format(""), "[REDACTED_PRIVATE_KEY]", "MIIE"),
    ("AccountKey=" + "Ab3/" * 8 + "==;Endpoint=x", "AccountKey=[REDACTED_STORAGE_KEY];Endpoint=x", "Ab3/"),
    ("postgres://app:s3cr@db:5432/x", "postgres://[REDACTED_CONNECTION]@db:5432/x", "s3cr"),
    ("the password is long", "the password is long", None),
    ("secret = \"AKIA" + "C" * 16 + '"', "secret = [REDACTED_CREDENTIAL]", "C" * 16),
    ('{"password": "hunter2"}', '{"password": [REDACTED_CREDENTIAL]}', "hunter2"),
    ('{\\"password\\": \\"hunter2\\"}', '{\\"password\\": [REDACTED_CREDENTIAL]}', "hunter2"),
    ("password=hunter2 next", "password=[REDACTED_CREDENTIAL] next", "hunter2"),
    ("TOKEN=swordfish&x=1", "TOKEN=[REDACTED_CREDENTIAL]&x=1", "swordfish"),
    ("password: s3cr3t!", "password: [REDACTED_CREDENTIAL]", "s3cr3t"),
    ('secret="a\'b" c', "secret=[REDACTED_CREDENTIAL] c", "a'b"),
    ("secret='a\"b' c", "secret=[REDACTED_CREDENTIAL] c", 'a"b'),
    ("Authorization: Bearer abc.def", "Authorization: Bearer [REDACTED_AUTHORIZATION]", "abc.def"),
    ('{"authorization": "Basic dXNlcg=="}', '{"authorization": "Basic [REDACTED_AUTHORIZATION]"}', "dXNlcg"),
    ("bearer " + "aB3-" * 6, "bearer [REDACTED_BEARER]", "aB3-"),
    ("the bearer of this letter", "the bearer of this letter", None),
    (PEM.format("OPENSSH "), "[REDACTED_PRIVATE_KEY]", "MIIE"),
    (PEM.format("ENCRYPTED "), "[REDACTED_PRIVATE_KEY]", "MIIE"),
    ("-----BEGIN PGP PRIVATE KEY BLOCK-----\nlQOY\n-----END PGP PRIVATE KEY BLOCK-----", "[REDACTED_PRIVATE_KEY]", "lQOY"),
    ("AWS_SECRET_ACCESS_KEY=wJalrXUtnFEMI/bPxRfiCYEXAMPLEKEY", "AWS_SECRET_ACCESS_KEY=[REDACTED_CREDENTIAL]", "wJalr"),
    ('export AWS_SECRET_ACCESS_KEY="wJalrXUtnFEMI" x', "export AWS_SECRET_ACCESS_KEY=[REDACTED_CREDENTIAL] x", "wJalr"),
    ("passwd=hunter2", "passwd=[REDACTED_CREDENTIAL]", "hunter2"),
    ("Server=a;Uid=b;Pwd=abcd;", "Server=a;Uid=b;Pwd=[REDACTED_CREDENTIAL];", "abcd"),
    ("PWD=/home/user1 OLDPWD=/tmp/a2", "PWD=/home/user1 OLDPWD=/tmp/a2", None),
    ("SharedAccessKeyName=Root;SharedAccessKey=" + "aB1+" * 10 + "=;E=1", "SharedAccessKeyName=Root;SharedAccessKey=[REDACTED_STORAGE_KEY];E=1", "aB1+"),
    ("push with ghp_" + "a1B2" * 9, "push with [REDACTED_PROVIDER_TOKEN]", "a1B2"),
    ("xoxb-123456789012-abcDEF.", "[REDACTED_PROVIDER_TOKEN].", "abcDEF"),
    ("sk-proj-" + "a1B2" * 6, "[REDACTED_PROVIDER_TOKEN]", "a1B2"),
    ("the task-scheduler-configuration-of-everything", "the task-scheduler-configuration-of-everything", None),
    ("curl -s -u user:pass http://x", "curl -s -u user:[REDACTED_CREDENTIAL] http://x", "pass "),
    ("curl http://x --user='me:p w'", "curl http://x --user='me:[REDACTED_CREDENTIAL] w'", "p w"),
    ("password: correcthorse\nnext", "password: [REDACTED_CREDENTIAL]\nnext", "correcthorse"),
    ("password: correcthorse", "password: [REDACTED_CREDENTIAL]", "correcthorse"),
    ("password: something that prose says", "password: something that prose says", None),
    ('{"password": "a\\"b1", "x": 1}', '{"password": [REDACTED_CREDENTIAL], "x": 1}', "b1"),
    ('{\\"password\\": \\"a\\\\\\"b1\\", \\"x\\": 1}', '{\\"password\\": [REDACTED_CREDENTIAL], \\"x\\": 1}', "b1"),
    ('password="hunter', "password=[REDACTED_CREDENTIAL]", "hunter"),
    ("-----BEGIN RSA PRIVATE KEY-----\nMIIE\nabc\n", "[REDACTED_PRIVATE_KEY]", "MIIE"),
    ("input_tokens: 512, token_count: 5, max_tokens=100", "input_tokens: 512, token_count: 5, max_tokens=100", None),
    ("", "", None),
    (None, None, None),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "id int, text string")


def test_expected_texts(texts):
    got = {r.id: r.out for r in texts.select("id", redact("text").alias("out")).collect()}
    assert got == {i: c[1] for i, c in enumerate(CASES)}


def test_no_secret_survives_and_twice_changes_nothing(texts):
    once = texts.select("id", redact("text").alias("out"))
    twice = {r.id: r.again for r in once.select("id", redact("out").alias("again")).collect()}
    for row in once.collect():
        secret = CASES[row.id][2]
        assert secret is None or secret not in row.out
        assert twice[row.id] == row.out


def test_flag_can_be_told_from_the_raw_text(texts):
    rows = texts.select(
        F.coalesce(is_flagged(redact("text")), F.lit(False)).alias("after"),
        F.coalesce(will_be_flagged("text"), F.lit(False)).alias("before"),
    ).collect()
    assert all(r.after == r.before for r in rows)
    assert sum(r.before for r in rows) == sum(c[2] is not None for c in CASES)


def test_hits_and_matches_agree(texts):
    rules = SECRET_RULES + PERSONAL_RULES
    for row in texts.filter("text is not null").select(hits("text", rules).alias("n"), matched_rules("text", rules).alias("m")).collect():
        assert [r.name for r, n in zip(rules, row.n) if n > 0] == row.m


def test_personal_rules(spark):
    text = "mail ann@mail.example.org from 10.0.0.7 with 4111 1111 1111 1111"
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(redact("text", PERSONAL_RULES)).first()[0] == (
        "mail [REDACTED_EMAIL] from [REDACTED_IP] with [REDACTED_CARD]"
    )


def test_random_texts_against_a_plain_fold(spark):
    """Whole texts of prose, secrets and near misses, redacted by Python's own expressions."""
    rng = random.Random(11)
    pieces = [c[0] for c in CASES if c[0]] + [
        "token", "= 'x", "secret:", "http://", "user:pw@", "AKIA", "eyJ", "\n", "é ß", "key", "-----BEGIN EC PRIVATE KEY-----",
    ]
    texts = [rng.choice(["", " ", ". "]).join(rng.choices(pieces, k=rng.randrange(1, 9))) for _ in range(400)]

    def fold(text):
        for rule in SECRET_RULES:
            pattern, put = rule.pattern.replace(r"\z", r"\Z"), rule.replacement.replace("$", "\\")
            text = re.sub(pattern, put, text, flags=re.IGNORECASE | re.ASCII)
        return text

    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r for r in df.select("id", redact("text").alias("out"), will_be_flagged("text").alias("flag")).collect()}
    for i, text in enumerate(texts):
        assert got[i].out == fold(text)
        assert got[i].flag == ("[REDACTED_" in fold(text))


def test_long_values_need_no_stack(spark):
    long = "x\\\"" * 100_000
    df = spark.createDataFrame([(f'token = "{long}" end',), (f"secret='{'y' * 300_000}' end",), ("-----BEGIN PRIVATE KEY-----" + "z" * 300_000,)], "text string")
    got = [r.out for r in df.select(redact("text").alias("out")).collect()]
    assert got == ["token = [REDACTED_CREDENTIAL] end", "secret=[REDACTED_CREDENTIAL] end", "[REDACTED_PRIVATE_KEY]"]


def test_tokens_that_look_random(spark):
    """Recall on planted strings of several alphabets; names, paths, digests, numbers and long words are left alone."""
    import math
    import string
    from collections import Counter

    from tracelode.functions import entropy

    rng = random.Random(4)
    alphabets = (string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_uppercase + "234567", string.ascii_lowercase + string.digits)
    planted = ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(24, 90))) for _ in range(800)]
    clean = [
        "getElementsByClassNameAndOtherThings", "my_long_identifier_name_2", "internationalization20", "550e8400-e29b-41d4-a716-446655440000",
        "d41d8cd98f00b204e9800998ecf8427e", "da39a3ee5e6b4b0d3255bfef95601890afd80709", "12345678901234567890123", "/usr/local/lib/python3/site-packages",
        "Donaudampfschifffahrtsgesellschaft", "AAAAAAAAAAAAAAAAAAAAAAAAAAA1", "2026-03-02T10-00-00-000000", "release/2024-10/build_12345/index",
    ]
    df = spark.createDataFrame(list(enumerate(planted + clean)), "id int, token string")
    got = {r.id: r for r in df.select("id", entropy.relative_entropy(F.col("token")).alias("h"), entropy.looks_random(F.col("token")).alias("yes")).collect()}
    for i, token in enumerate(planted + clean):
        n = len(token)
        assert abs(got[i].h - (1 - sum(k * math.log2(k) for k in Counter(token).values()) / (n * math.log2(n)))) < 1e-9
    assert sum(got[i].yes for i in range(len(planted))) >= 0.99 * len(planted)
    assert [t for i, t in enumerate(clean) if got[len(planted) + i].yes] == []
    text = f"see {planted[0]}, {clean[0]} and\n{planted[1]}."
    found = spark.createDataFrame([(text,), (None,), ("",)], "text string").select(entropy.unkeyed_secrets("text")).collect()
    assert [r[0] for r in found] == [planted[:2], None, []]
