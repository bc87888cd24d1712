"""Secret scan: candidates by a pattern, false positives removed by a random forest. DataFrame functions only.

A candidate is a run of 16 or more key characters that has a digit, begins with 16 capitals and digits or changes twice
from small letters to capitals; or any value after a secret word and ``=`` or ``:``, whatever its length and characters;
or the password of an address (``://user:password@``). Its features
are length, transitions between kinds of characters, share covered by dictionary words, the path it lies in and the
words beside it. The forest is trained on labelled findings; see ``rule_labels`` for where they come from if nobody has
labelled any.

Null text has no candidates; an empty table gives no rows and an untrained forest. If the labelled findings are all of
one kind there is nothing to separate and every candidate gets that kind; with none, every candidate counts as a
secret. Each row is scanned for itself, whatever its key. Spans count code points from 0. Only key, text and path are
read, and ``redacted`` keeps all columns.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import place, stored

_RUN = "[A-Za-z0-9+/_-]"
_WORDS = "token|secret|passw(?:or)?d|pwd|api.?key|auth|credential|bearer|private"
_ASSIGN = f"(?i:{_WORDS})s?(?:[_-][A-Za-z0-9_-]{{1,20}})?[\"']?\\s{{0,3}}[=:]\\s{{0,3}}"
_VALUE = (
    f"(?<=[=:]\\s{{0,3}}[\"']?)(?:(?<={_ASSIGN}\")[^\"\\s][^\"\\r\\n]*+(?=\")|(?<={_ASSIGN}')[^'\\s][^'\\r\\n]*+(?=')"
    f"|(?<={_ASSIGN})(?![\"'])\\S*[^\\s\"',;.)\\]}}>])")
_USERINFO = "(?<=:)(?<=://[^\\s/:@]{0,64}:)[^\\s/@]++(?=@)"
_KEY = (
    f"(?<!{_RUN})(?:(?=[A-Za-z+/_-]*+[0-9])|(?=[A-Z0-9]{{16}})"
    f"|(?=[A-Z+/_-]*+[a-z][a-z+/_-]*+[A-Z][A-Z+/_-]*+[a-z][a-z+/_-]*+[A-Z])){_RUN}{{16,}}")
CANDIDATE = f"{_VALUE}|{_USERINFO}|{_KEY}"
#: Words that keys and their stand-ins are made of.
DICTIONARY = (
    "access", "account", "admin", "alpha", "api", "auth", "backup", "base", "beta", "build", "cache", "changeme",
    "class", "client", "cluster", "code", "com", "config", "connection", "content", "credential", "data", "default",
    "demo", "dev", "doc", "download", "dummy", "email", "en", "engine", "env", "error", "event", "example", "external",
    "false", "file", "fixture", "foo", "group", "hash", "home", "host", "html", "http", "https", "id", "image", "index",
    "info", "ing", "integration", "internal", "item", "job", "key", "lib", "license", "list", "local", "login", "mail",
    "master", "message", "mock", "model", "module", "my", "name", "net", "node", "null", "number", "object", "order",
    "org", "page", "param", "part", "password", "path", "placeholder", "private", "prod", "product", "project", "public",
    "query", "release", "request", "response", "role", "root", "sample", "schema", "script", "secret", "server",
    "service", "session", "source", "src", "staging", "static", "status", "string", "system", "table", "tag", "target",
    "task", "temp", "test", "the", "tion", "token", "tool", "true", "type", "update", "url", "user", "util", "value",
    "version", "web", "width", "www", "your",
)
FEATURES = (
    "length", "transitions", "digit_share", "upper_share", "letter_runs", "hex_only", "dictionary_share", "path_depth",
    "path_is_example", "assigned", "secret_word", "quoted", "in_address", "followed_by_mark", "known_prefix",
    "userinfo", "path_token",
)
_SECRET_WORD = f"(?i)({_WORDS})"
#: A part of a path that has digits, capitals and small letters and is long.
_PATH_TOKEN = "(^|/)(?=[A-Za-z_-]*+[0-9])(?=[a-z0-9_-]*+[A-Z])(?=[A-Z0-9_-]*+[a-z])[A-Za-z0-9_-]{20,}$"


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = "source") -> DataFrame:
    """One row per candidate of ``docs``, read from Parquet: doc_key, at (locator), number, start, candidate, before,
    after, path."""
    body = F.col(text)
    rows = docs.select(
        F.col(key).alias("doc_key"), place().alias("at"), body.alias("body"),
        (F.col(path) if path else F.lit("")).alias("path")).where(F.col("body").rlike(CANDIDATE))
    split = rows.select(
        "doc_key", "at", "path", F.split("body", CANDIDATE, -1).alias("pieces"),
        F.regexp_extract_all("body", F.lit(CANDIDATE), F.lit(0)).alias("found"))
    each = split.select(
        "doc_key", "at", "path",
        F.posexplode(F.zip_with(
            F.arrays_zip(F.col("pieces").alias("before"), F.col("found").alias("candidate")),
            F.slice("pieces", F.lit(2), F.size("found") + 1),
            lambda a, after: F.struct(a["before"].alias("before"), a["candidate"].alias("candidate"), after.alias("after")),
        )).alias("number", "c")).select("doc_key", "at", "path", "number", "c.*").where("candidate IS NOT NULL")
    upto = Window.partitionBy("at").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.char_length("before") + F.char_length("candidate")).over(upto)
    return each.select(
        "doc_key", "at", "number", (end - F.char_length("candidate")).alias("start"), "candidate",
        F.regexp_extract(F.right("before", F.lit(60)), "(\\S*\\s*\\S*\\s*\\S*)$", 1).alias("before"),
        F.regexp_extract(F.left("after", F.lit(40)), "^(\\S*\\s*\\S*)", 1).alias("after"),
        F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"))


def features(dictionary: tuple[str, ...] = DICTIONARY) -> dict[str, Column]:
    c, size = F.col("candidate"), F.char_length("candidate")
    words = "|".join(sorted(dictionary, key=lambda w: (-len(w), w)))

    def share(pattern: str) -> Column:
        return F.regexp_count(c, F.lit(pattern)) / size

    def flag(condition: Column) -> Column:
        return condition.cast("double")
    return {
        "length": size.cast("double"),
        "transitions": share("[a-z](?=[A-Z0-9])|[A-Z](?=[a-z0-9])|[0-9](?=[A-Za-z])"),
        "digit_share": share("[0-9]"),
        "upper_share": share("[A-Z]"),
        "letter_runs": F.regexp_count(c, F.lit("[A-Za-z]{5,}")).cast("double"),
        "hex_only": flag(c.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "dictionary_share": 1 - F.char_length(F.regexp_replace(F.lower(c), f"({words})", "")) / size,
        "path_depth": F.regexp_count("path", F.lit("/")).cast("double"),
        "path_is_example": flag(F.col("path").rlike("(?i)(test|example|fixture|sample|mock|doc)")),
        "assigned": flag(F.col("before").rlike("[=:]\\s*[\"']?$")),
        "secret_word": flag(F.col("before").rlike(_SECRET_WORD)),
        "quoted": flag(F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")),
        "in_address": flag(F.col("before").rlike("(://|@|\\.)\\S*$") | F.col("after").rlike("^[@.][A-Za-z]")),
        "followed_by_mark": flag(F.col("after").rlike("^[!?#*$%&|]")),
        "userinfo": flag(_userinfo()),
        "path_token": flag(c.rlike(_PATH_TOKEN)),
        "known_prefix": flag(c.rlike("^(AKIA|ASIA|ghp_|gho_|xox[abp]-|AIza|sk-|sk_live_|eyJ)")),
    }


def _userinfo() -> Column:
    """Between the colon after a user's name and the @; the name may be a candidate itself."""
    return F.col("before").rlike("(^|://[^\\s/:@]*):$") & F.col("after").rlike("^@")


def rule_labels() -> Column:
    """Labels for findings nobody has looked at: 1 for formats, assignments, passwords in addresses and tokens of
    webhooks that leave no doubt, 0 for plain numbers, other parts of addresses but for tokens, ordinary words in
    capitals, words made of dictionary words, and assigned calls and stand-ins; null for all others."""
    c, before, after = F.col("candidate"), F.col("before"), F.col("after")
    assigned = before.rlike(_ASSIGN + "[\"']?$")
    code = assigned & c.rlike("^[A-Za-z_][A-Za-z0-9_.]*[(\\[]|^[$<{%&*]|^(?i)(none|null|nil|true|false|str|string|x+)$")
    mixed = c.rlike("[0-9]") | c.rlike("[a-z][A-Z].*[a-z][A-Z]") | (c.rlike("[~!@#%^&*+=?.]") & (F.char_length(c) >= 8))
    token = c.rlike(_PATH_TOKEN)
    address = before.rlike("(://|@)\\S*$") | after.rlike("^@")
    hook = address & token & F.concat(before, c).rlike("(?i)hook|/services/")
    sure = c.rlike("^(AKIA|ASIA)[0-9A-Z]{16}$") | (assigned & mixed & c.rlike("[A-Za-z]")) | _userinfo() | hook
    word = c.rlike("^[A-Z]+$") & ~c.rlike("^(AKIA|ASIA)") | F.col("dictionary_share").between(0.8, 1)
    return F.when(code, 0).when(sure, 1).when((address & ~token) | word | c.rlike("^[0-9]+$"), 0)


class Forest:
    """Random forest over findings. ``score`` is the share of trees' votes for a secret."""

    def __init__(self, model=None, constant: float = 1.0):
        self.model, self.constant = model, constant

    def scored(self, findings: DataFrame) -> DataFrame:
        if self.model is None:
            return findings.withColumn("score", F.lit(self.constant))
        inputs = VectorAssembler(inputCols=list(FEATURES), outputCol="features_", handleInvalid="keep").transform(findings)
        return self.model.transform(inputs).withColumn("score", vector_to_array("probability")[1]).drop(
            "features_", "rawPrediction", "probability", "prediction")


def train(findings: DataFrame, label: str = "label", max_findings: int = 4000, trees: int = 20, depth: int = 6,
          seed: int = 7) -> Forest:
    """Train on labelled findings with features: at most ``max_findings`` of each kind, those with the smallest hash.
    Copies of a finding count once."""
    known = findings.where(F.col(label).isNotNull()).select(
        "candidate", "before", "after", *FEATURES, F.col(label).cast("double").alias("label_")).distinct().select(
        *FEATURES, "label_", F.xxhash64("candidate", "before", "after").alias("h"))
    kinds = [known.where(F.col("label_") == k).orderBy("h", *FEATURES).limit(max_findings) for k in (0.0, 1.0)]
    sample = stored(reduce(DataFrame.unionByName, kinds), "findings")
    counts = {r["label_"]: r["count"] for r in sample.groupBy("label_").count().collect()}
    if len(counts) < 2:
        return Forest(constant=next(iter(counts), 1.0))
    inputs = VectorAssembler(inputCols=list(FEATURES), outputCol="features_", handleInvalid="keep").transform(
        sample.repartition(1).sortWithinPartitions("h", *FEATURES))
    forest = RandomForestClassifier(
        featuresCol="features_", labelCol="label_", numTrees=trees, maxDepth=depth, seed=seed, minInstancesPerNode=2)
    return Forest(forest.fit(inputs))


def findings(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = "source",
             label: Callable[[], Column] = rule_labels, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """Every candidate with its span, score and ``secret``. ``labelled`` has candidate, before, after, path and label;
    without it the rules label what they can."""
    def with_features(df: DataFrame) -> DataFrame:
        return df.withColumns(features())
    found = stored(with_features(candidates(docs, key, text, path)), "candidates")
    forest = train(found.withColumn("label", label()) if labelled is None else with_features(labelled))
    return forest.scored(found).withColumn("secret", F.col("score") >= threshold).drop(*FEATURES)


def redacted(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = "source",
             mark: str = "[SECRET]", length: str | None = "n_chars") -> DataFrame:
    """``docs``, read from Parquet, with secrets replaced by ``mark``; a column ``length`` follows the new text."""
    found = findings(docs, key, text, path).where("secret").select("at", "number")
    numbers = stored(found.groupBy("at").agg(F.collect_set("number").alias("numbers")).withColumnRenamed("at", "there"), "redactions")
    rows = docs.select(F.struct("*").alias("d"), place().alias("at")).join(numbers.hint("merge"), F.col("at") == F.col("there"), "left")
    body = F.col("d")[text]
    parts = F.transform(
        F.regexp_extract_all(body, F.lit(CANDIDATE), F.lit(0)),
        lambda c, i: F.when(F.array_contains("numbers", i), F.lit(mark)).otherwise(c))
    joined = F.array_join(F.zip_with(
        F.split(body, CANDIDATE, -1), parts, lambda piece, c: F.concat(piece, F.coalesce(c, F.lit("")))), "")
    new = F.when(F.col("numbers").isNull(), body).otherwise(joined)
    columns = []
    for name in docs.columns:
        if name == text:
            columns.append(new.alias(name))
        elif name == length:
            columns.append(F.when(F.col("numbers").isNull(), F.col("d")[name]).otherwise(
                F.char_length(new)).cast(docs.schema[name].dataType).alias(name))
        else:
            columns.append(F.col("d")[name].alias(name))
    return rows.select(*columns)
