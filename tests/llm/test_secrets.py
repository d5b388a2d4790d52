"""Names and values in .env and URL form, and assigned hashes that are no secrets."""

import hashlib

from lingmill.llm import secrets

KEY = hashlib.sha1(b"own key").hexdigest()
FORMS = [
    ("SERVICE_API_KEY={}", True),
    ("MY_VERY_LONG_SERVICE_SECRET_TOKEN={}", True),
    ("see https://api.shop7.org/v1/x?token={}&page=2", True),
    ('token = "{}"', True),
    ('commit = "{}"', False),
    ('the checksum = "{}" of it', False),
    ("sha256={}", False),
]


def test_env_url_and_hash_forms(spark):
    docs = spark.createDataFrame([(i, f.format(KEY), "src1") for i, (f, _) in enumerate(FORMS)], "doc_id long, text string, source string")
    found = secrets.scan_secrets(docs, secrets.made_findings(spark)).collect()
    assert {r["secret"] for r in found} == {KEY} and len(found) == len(FORMS)
    assert {r["doc_id"]: r["is_secret"] for r in found} == {i: yes for i, (_, yes) in enumerate(FORMS)}


def test_padding_stays_with_the_value(spark):
    docs = spark.createDataFrame([(1, "key=QUJDREVGR0hJSktMTU5PUA== and more", "s")], "doc_id long, text string, source string")
    row = secrets.candidates(docs, "doc_id", "text", "source", secrets.SecretOptions()).first()
    assert (row["candidate"], row["before"]) == ("QUJDREVGR0hJSktMTU5PUA==", "key=")


def b64(seed, n):
    import base64

    raw = b"".join(hashlib.sha256(f"{seed}{i}".encode()).digest() for i in range(3))
    return base64.b64encode(raw).decode()[:n]


def unseen_forms():
    """(text, value, whether it is a secret) in forms that the made findings do not have."""
    hex_ = lambda k, n: hashlib.sha512(f"unseen {k}".encode()).hexdigest()[:n]
    yes = [
        "aws_secret_access_key = {}", "STRIPE_SECRET={}", "db.password: {}", "export GITHUB_TOKEN='{}'", "X-Api-Key: {}",
        'const apiKey = "{}";', "mysql_pwd={}", "?auth_token={}&v=2", "--password {}", "Authorization: Token {}",
        '"clientSecret": "{}"', "my secret is {}", "oauth_secret = '{}'", "login password {} now", "SESSION_SECRET: \"{}\"",
    ]
    no = [
        "git checkout {}", "commit {}", "sha1 {}", "MD5 ({})", "blob {} 12", "checksum: {}", "etag = \"{}\"", "index {}..", "revision {}",
        "sha256:{}", "image digest {}", "docker pull x@sha256:{}", "build id {}", "uuid {}", "object {} of the tree",
    ]
    for i, form in enumerate(yes):
        value = (hex_(i, 40), b64(i, 40), hex_(i, 64), b64(i, 32))[i % 4]
        yield form.format(value), value, True
    for i, form in enumerate(no):
        value = hex_(100 + i, (40, 64, 32)[i % 3])
        yield form.format(value), value, False
    keys = ["AKIA" + hex_(200, 16).upper(), "ghp_" + hex_(201, 36), "sk_live_" + hex_(202, 24), "xoxb-" + hex_(203, 32), "AIza" + b64(204, 35).replace("+", "a").replace("/", "b")]
    for i, key in enumerate(keys):
        for form in ("{}", "id {} there"):
            yield form.format(key), key, True
    names = [
        "supercalifragilisticexpialidocious", "attention_mask_for_padding", "internationalization_and_localization", "usr/local/lib/python/dist-packages",
        "getElementsByClassNameAndId", "some-very-long-css-class-name", "com/example/project/service/impl", "antidisestablishmentarianism",
        "MAXIMUM_NUMBER_OF_RETRIES", "default_token_expiration_policy",
    ]
    for i, name in enumerate(names):
        for form in ("key = {}", "the secret {} here", "token_type_ids = {}"):
            yield form.format(name), name, False


def test_unseen_forms(spark):
    rows = list(unseen_forms())
    assert len(rows) >= 70
    docs = spark.createDataFrame([(i, t, "src1") for i, (t, _, _) in enumerate(rows)], "doc_id long, text string, source string")
    judged = {(r["doc_id"], r["secret"]): r["is_secret"] for r in secrets.scan_secrets(docs, secrets.made_findings(spark)).collect()}
    said = [(judged.get((i, v), False), yes) for i, (_, v, yes) in enumerate(rows)]
    for (got, yes), (text, _, _) in zip(said, rows):
        if got != yes:
            print("wrong:", yes, text)
    right = sum(got and yes for got, yes in said)
    precision, recall = right / sum(got for got, _ in said), right / sum(yes for _, yes in said)
    print(f"precision {precision:.2f}, recall {recall:.2f}")
    assert precision >= 0.9 and recall >= 0.9


def test_names_are_no_candidates(spark):
    docs = spark.createDataFrame([(1, 'aws_secret_access_key = ' + KEY + ' "long_name_of_a_field": "' + KEY + '"', "s")], "doc_id long, text string, source string")
    found = secrets.candidates(docs, "doc_id", "text", "source", secrets.SecretOptions()).collect()
    assert [r["candidate"] for r in found] == [KEY, KEY]
    assert "aws_secret_access_key" in found[0]["before"] and "long_name_of_a_field" in found[1]["before"]
