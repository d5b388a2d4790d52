"""Secret scan with a random forest that removes false positives.

Long unbroken tokens are candidates. A forest trained from labelled findings tells secrets from what only looks
like them by the candidate's length, its character transitions, how much of it dictionary words cover, the path it
comes from, and the words around it. All of it runs on DataFrame expressions and Spark's own forest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lingmill.functions.bind import bind
from lingmill.llm.common import BLANKS
from lingmill.sources.shared import materialize

#: A whole run of at least 16 characters of keys, hashes and encoded bytes, with the padding of base64 behind it.
#: The name in NAME=value, and one without digits in name = value or "name": value, is none: it stands before the candidate.
CANDIDATE = (
    r"(?<![A-Za-z0-9+/_-])(?![A-Za-z_-]++[\"']?[ \t]*+[:=])[A-Za-z0-9+/_-]{16,}+(?!=+[A-Za-z0-9+/_-])={0,2}"
)
#: Letters that can be a dictionary word.
_SHORTEST = 4
_RUN = rf"[a-z]{{{_SHORTEST},}}"

# Words near a candidate that speak for and against a secret.
_FOR = r"(?i)(?<![a-z])(secret|token|passw(or)?d|passwd|pwd|api|key|auth|bearer|credentials?)(?![a-z])"
_AGAINST = (
    r"(?i)(?<![a-z])(example|sample|dummy|test|your|changeme|placeholder|commit|revision|digest|etag|integrity"
    r"|sha1|sha256|md5|checksum|uuid|id)(?![a-z])"
)
# How keys of some providers begin.
_PREFIX = r"^(AKIA|ASIA|AIza|gh[pousr]_|github_pat_|glpat-|sk_live_|rk_live_|sk-|xox[abprs]-|npm_|pypi-)"
_TEST_PATH = r"(?i)(test|example|sample|mock|fixture|doc)"


@dataclass(frozen=True)
class SecretOptions:
    """`train_rows` bounds the labelled candidates that the forest learns from: per label at most half, one per
    hash bucket. A word is in the dictionary if `min_documents` documents have it."""

    near_words: int = 4
    min_documents: int = 5
    train_rows: int = 8000
    trees: int = 20
    depth: int = 6
    seed: int = 7


FEATURES = (
    "length", "digits", "upper", "marks", "class_changes", "different", "odds", "coverage",
    "in_path", "test_path", "says_secret", "says_other", "assigned", "quoted", "known_prefix",
)


def candidates(docs: DataFrame, id_col: str, text: str, path: str, options: SecretOptions) -> DataFrame:
    """(id, finding, candidate, before, after, path): every candidate of the whole text, numbered from 1.

    `before` and `after` are the `near_words` nearest words on its line side, cut at the next candidate.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"),
        F.regexp_extract_all(body, F.lit(CANDIDATE), F.lit(0)).alias("found"),
        body.alias("body"),
    ).filter(F.size("found") > 0)
    # the same expression parts the text, so there is one part more than there are candidates
    parts = found.withColumn("parts", F.split("body", CANDIDATE)).drop("body")
    zipped = F.arrays_zip(
        F.col("found").alias("candidate"),
        F.slice("parts", 1, F.size("found")).alias("left"),
        F.slice("parts", 2, F.size("found")).alias("right"),
    )
    each = parts.select("id", "path", F.posexplode(zipped).alias("at", "x"))
    n = options.near_words

    def last_words(part: Column) -> Column:
        return bind(F.split(part, BLANKS), lambda w: F.array_join(F.slice(w, -F.least(F.size(w), F.lit(n)), n), " "))

    def first_words(part: Column) -> Column:
        return F.array_join(F.slice(F.split(part, BLANKS), 1, n), " ")

    return each.select(
        "id",
        (F.col("at") + 1).alias("finding"),
        F.col("x.candidate").alias("candidate"),
        last_words(F.col("x.left")).alias("before"),
        first_words(F.col("x.right")).alias("after"),
        "path",
    )


def _coverage(docs: DataFrame, text: str, tokens: DataFrame, options: SecretOptions) -> DataFrame:
    """(candidate, covered): letters of the candidate in dictionary words, for candidates that have any.

    The different words of each document are counted first, so that a task sends a word once at most; only
    then the counts meet the words that candidates have.
    """
    runs = tokens.select("candidate", F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit(_RUN), F.lit(0))).alias("word"))
    runs = materialize(runs)
    split = F.array_distinct(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^a-z]+"))
    words = docs.select(F.explode(split).alias("word")).filter(F.length("word") >= _SHORTEST)
    known = words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= options.min_documents)
    wanted = runs.select("word").distinct()
    known = known.join(wanted, "word", "left_semi")
    return runs.join(known.select("word"), "word").groupBy("candidate").agg(F.sum(F.length("word")).alias("covered"))


def _pairs(tokens: DataFrame) -> DataFrame:
    """(candidate, pair): neighbouring characters, digits as 0 and letters small."""
    plain = F.regexp_replace(F.lower("candidate"), "[1-9]", "0")
    at = F.sequence(F.lit(1), F.length("candidate") - 1)
    return tokens.select("candidate", plain.alias("plain"), F.explode(at).alias("i")).select(
        "candidate", F.substring("plain", F.col("i"), F.lit(2)).alias("pair")
    )


def _odds(tokens: DataFrame, labelled: DataFrame) -> DataFrame:
    """(candidate, odds): mean log odds of its character pairs, secrets against others, one added to each count."""
    counts = _pairs(labelled).join(labelled, "candidate").groupBy("pair").agg(
        F.sum("label").alias("yes"), F.sum(1 - F.col("label")).alias("no")
    )
    total = counts.agg(F.sum("yes").alias("all_yes"), F.sum("no").alias("all_no"), F.count("*").alias("kinds")).first()
    if not total["kinds"]:
        return tokens.select("candidate", F.lit(0.0).alias("odds"))
    kinds = total["kinds"]
    odds = F.log((F.col("yes") + 1) / (total["all_yes"] + kinds)) - F.log((F.col("no") + 1) / (total["all_no"] + kinds))
    learned = counts.select("pair", F.round(odds, 9).alias("pair_odds"))
    scored = _pairs(tokens).join(learned, "pair", "left")
    return scored.groupBy("candidate").agg(F.round(F.avg(F.coalesce("pair_odds", F.lit(0.0))), 6).alias("odds"))


def features(rows: DataFrame) -> DataFrame:
    """`rows` (candidates with `covered` and `odds`) with the columns of `FEATURES`."""
    c, size = F.col("candidate"), F.length("candidate")
    changes = r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"

    def share(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / size

    def yes(test: Column) -> Column:
        return test.cast("double")

    return rows.withColumns(
        {
            "length": size.cast("double"),
            "digits": share("[0-9]"),
            "upper": share("[A-Z]"),
            "marks": share("[+/_=-]"),
            "class_changes": F.regexp_count(c, F.lit(changes)) / (size - 1),
            "different": F.size(F.array_distinct(F.split(c, ""))) / size,
            "odds": F.coalesce("odds", F.lit(0.0)),
            "coverage": F.coalesce("covered", F.lit(0)) / size,
            "in_path": yes(F.rlike("before", F.lit(r"[/\\.:]$")) & ~F.rlike("before", F.lit(r"[=\"']\s*:?$")) | F.contains("candidate", F.lit("/"))),
            "test_path": yes(F.rlike("path", F.lit(_TEST_PATH))),
            "says_secret": yes(F.rlike(F.regexp_replace("before", "([a-z])([A-Z])", "$1 $2"), F.lit(_FOR))),
            "says_other": yes(F.rlike("before", F.lit(_AGAINST)) | F.rlike("after", F.lit(_AGAINST))),
            "assigned": yes(F.rlike("before", F.lit("[=:]\\s*[\"']?$"))),
            "known_prefix": yes(F.rlike("candidate", F.lit(_PREFIX))),
            "quoted": yes(F.rlike("before", F.lit("[\"']$")) & F.rlike("after", F.lit("^[\"']"))),
        }
    )


def _out_of_fold(tokens: DataFrame, labelled: DataFrame) -> DataFrame:
    """(candidate, odds): those of a labelled candidate come from the other half of the labelled ones, so that the
    forest does not learn from odds that already hold the label; those of all others from both halves."""
    half = F.pmod(F.xxhash64("candidate", F.lit("fold")), F.lit(2))
    parts = [_odds(labelled.filter(half == k).select("candidate"), labelled.filter(half != k)) for k in (0, 1)]
    others = tokens.join(labelled.select("candidate"), "candidate", "left_anti")
    return parts[0].unionByName(parts[1]).unionByName(_odds(others, labelled))


def scan_secrets(
    docs: DataFrame,
    labelled: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    path: str = "source",
    options: SecretOptions = SecretOptions(),
) -> DataFrame:
    """One row per candidate in `docs`: id, finding (1, 2, ... in the text), secret, probability, is_secret.

    `labelled` holds known findings: candidate, before, after, path, label (1 a secret, 0 not). Rows with a NULL
    candidate or label teach nothing; NULL words and paths count as empty. If the findings are all of one label, that
    is every candidate's. Without any, the probability is NULL and nothing is a secret. A probability of one half
    is none. NULL and empty texts have no candidates; texts of any length are read whole. Repeated rows give
    repeated candidates; features depend on the candidate alone where they are joined, so a candidate in a third of
    all rows is worked out once. An empty table gives an empty result. Other columns are neither read nor returned.
    """
    return judge_candidates(materialize(candidates(docs, id_col, text, path, options)), docs, labelled, id_col, text, options)


def judge_candidates(
    found: DataFrame, docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text: str = "text", options: SecretOptions = SecretOptions()
) -> DataFrame:
    """`scan_secrets` for candidates that are already there as a table (`found`, as `candidates` gives them)."""
    known = labelled.filter("candidate is not null and label is not null").select(
        "candidate", *(F.coalesce(c, F.lit("")).alias(c) for c in ("before", "after", "path")), F.col("label").cast("int").alias("label")
    )
    half = max(1, options.train_rows // 2)
    order = F.xxhash64("candidate", "before", "after", "path")
    known = known.withColumn("h", order).withColumn("bucket", F.pmod("h", F.lit(half)))
    row = F.struct("h", "candidate", "before", "after", "path")
    train = materialize(known.groupBy("label", "bucket").agg(F.min(row).alias("row")).select("row.candidate", "row.before", "row.after", "row.path", "label"))
    tokens = materialize(found.select("candidate").union(train.select("candidate")).distinct())
    by_label = train.groupBy("candidate").agg(F.max("label").alias("label"))
    facts = materialize(
        tokens.join(_coverage(docs, text, tokens, options), "candidate", "left").join(_out_of_fold(tokens, by_label), "candidate", "left")
    )
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features")

    def ready(rows: DataFrame) -> DataFrame:
        return assemble.transform(features(rows.join(facts, "candidate")))

    labels = sorted(r["label"] for r in train.select("label").distinct().collect())
    if labels == [0, 1]:
        # a bounded table in one order, so that the forest is the same on every run
        learn = ready(train).select("features", F.col("label").cast("double").alias("label"), "candidate", "before", "after", "path")
        learn = materialize(learn.coalesce(1).sortWithinPartitions("candidate", "before", "after", "path", "label"))
        forest = RandomForestClassifier(numTrees=options.trees, maxDepth=options.depth, seed=options.seed).fit(learn)
        judged = forest.transform(ready(found)).withColumn("p", F.round(vector_to_array("probability")[1], 6))
    else:
        judged = found.withColumn("p", F.lit(float(labels[0]) if labels else None).cast("double"))
    return judged.select(
        F.col("id").alias(id_col),
        "finding",
        F.col("candidate").alias("secret"),
        F.col("p").alias("probability"),
        F.coalesce(F.col("p") > 0.5, F.lit(False)).alias("is_secret"),
    )


def findings_by_rule(found: DataFrame) -> DataFrame:
    """Labels for candidates where context leaves no doubt: 1 for letters and digits that are assigned, in quotes,
    to the name of a secret; 0 for all that are neither assigned nor near such a name."""
    named = F.rlike("before", F.lit(r"""(?i)(?<![a-z])(secret|token|passw(or)?d|api[_-]?key)["']?\s*[:=]\s*["']$"""))
    mixed = F.rlike("candidate", F.lit("[0-9]")) & F.rlike("candidate", F.lit("[A-Za-z]"))
    clear = ~F.rlike("before", F.lit(_FOR)) & ~F.rlike("before", F.lit("[=:]\\s*[\"']?$"))
    label = F.when(named & mixed, 1).when(clear, 0)
    return found.withColumn("label", label).filter("label is not null")


# What stands before and behind a value that was made as a secret (1) or as something else (0).
_MADE = (
    (1, 'token = "', '"'), (1, "API_KEY=", "\n"), (1, "export AWS_SECRET_KEY=", "\n"), (1, "DB_PASSWORD=", "\n"),
    (1, "https://h.org/a?token=", "&x=1"), (1, "https://h.org/a?api_key=", " "), (1, "Authorization: Bearer ", "\n"),
    (1, "secret: '", "'"), (1, '"password": "', '"'), (1, "auth_token=", "\n"), (1, "client_secret = ", "\n"),
    (1, '"access_token" : "', '",'), (1, "passwd: ", "\n"), (1, "private_api_key = '", "'"),
    (0, 'commit = "', '"'), (0, 'checksum = "', '"'), (0, "sha256: ", "\n"), (0, "md5=", "\n"), (0, 'digest = "', '"'),
    (0, 'etag: "', '"'), (0, "GIT_COMMIT=", "\n"), (0, "https://h.org/a?commit=", " "), (0, 'revision = "', '"'),
    (0, "uuid: '", "'"), (0, "CHECKSUM=", "\n"), (0, 'integrity = "', '"'), (0, 'example token = "', '"'),
    (0, '"integrity": "sha512-', '",'), (0, "url(data:image/png;base64,", ")"), (0, "file ", " was read"), (0, "fingerprint of ", "\n"),
)
#: Where names made of words stand: they are no secrets, even behind the name of one.
_NAMED = (
    'token = "', "key = ", "secret: ", "password = get(", "import ", "from ", "the ", "class ", "api_key=", "auth = ", "see /",
    "call ", "key: ", "token_type = ", "credentials = ",
)
#: Where keys stand that are known by how they begin.
_KEYED = ("use ", "key = ", 'x = "', "", "curl -u ", "AWS_ID=", "login with ")
# Words that names are made of.
_WORDS = (
    "attention mask padding token type config session manager handler request response connection pool worker queue index "
    "default value internal external abstract factory builder reader writer stream buffer translation location image "
    "resource user account service client server database table column record message event listener callback option"
).split()
#: Values made for each form.
_MADE_VALUES = 40


def made_findings(spark: SparkSession, options: SecretOptions = SecretOptions()) -> DataFrame:
    """Labelled findings whose label is known as they are made, not by a rule over features.

    Every form of `_MADE` holds the same kinds of values (hexadecimal of 32, 40 and 64 characters, base64 with all its
    characters), so a value tells nothing: assigned hashes are the hard negatives, .env lines and URLs the secrets without
    quotes. Names, paths and long words are never secrets, whatever stands before them; keys with the
    beginning that their provider gives them always are.
    """

    def of(forms: tuple) -> DataFrame:
        known = F.array(*(F.struct(F.lit(n).alias("label"), F.lit(a).alias("a"), F.lit(b).alias("b")) for n, a, b in forms))
        each = spark.range(_MADE_VALUES).select("id", F.explode(known).alias("form"))
        return each.withColumn("seed", F.concat_ws(" ", F.col("id").cast("string"), "form.label", "form.a"))

    seed, kind = F.col("seed"), F.col("id") % 5
    bytes_ = F.unhex(F.sha2(seed, 256))
    value = (
        F.when(kind == 0, F.sha1(seed))
        .when(kind == 1, F.sha2(seed, 256))
        .when(kind == 2, F.upper(F.md5(seed)))
        .when(kind == 3, F.base64(F.unhex(F.sha1(seed))))
        .otherwise(F.substring(F.base64(bytes_), 1, 40))
    )
    words = F.array(*map(F.lit, _WORDS))
    pick = lambda k: F.get(words, F.pmod(F.xxhash64(seed, F.lit(k)), F.lit(len(_WORDS))).cast("int"))
    four = [pick(k) for k in range(4)]
    name = (
        F.when(kind == 0, F.concat_ws("_", *four))
        .when(kind == 1, F.concat(four[0], *(F.initcap(w) for w in four[1:])))
        .when(kind == 2, F.concat_ws("-", *four))
        .when(kind == 3, F.concat_ws("/", *four))
        .otherwise(F.concat(*four[:3], F.lit("ization")))
    )
    letters = F.regexp_replace(F.base64(bytes_), "[+/=]", "")
    key = (
        F.when(kind == 0, F.concat(F.lit("AKIA"), F.upper(F.substring(F.sha2(seed, 256), 1, 16))))
        .when(kind == 1, F.concat(F.lit("ghp_"), F.substring(letters, 1, 36)))
        .when(kind == 2, F.concat(F.lit("sk_live_"), F.substring(letters, 1, 24)))
        .when(kind == 3, F.concat(F.lit("xoxb-"), F.substring(letters, 1, 30)))
        .otherwise(F.concat(F.lit("AIza"), F.substring(letters, 1, 35)))
    )
    rows = (
        of(_MADE).withColumn("value", value)
        .unionByName(of(tuple((0, a, " ") for a in _NAMED)).withColumn("value", name))
        .unionByName(of(tuple((1, a, " ") for a in _KEYED)).withColumn("value", key))
    )
    text = F.concat(F.lit("set here "), F.col("form.a"), "value", F.col("form.b"))
    found = candidates(rows.select(F.col("form.label").alias("label"), text.alias("text"), F.lit("src").alias("source")), "label", "text", "source", options)
    return found.withColumnRenamed("id", "label").select("candidate", "before", "after", "path", "label")
