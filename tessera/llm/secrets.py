"""Secret scan: a random forest tells secrets from false positives, DataFrame functions only.

A candidate is a value of 6 to 256 characters that a secret-like name (password, token, api_key and
the like, also inside a longer name) assigns, in quotes any one-line text, else without white space,
quotes, commas, semicolons and brackets; or a run of 16 or more letters, digits and ``+/=_-``.  A
``NAME=`` at the start of a run belongs to the text before the candidate.  Its features are
  * its length and the shares of its character classes;
  * character transitions: how often the class changes from one character to the next, and the
    mean log-odds of its transitions between characters, counted over the labelled findings;
  * dictionary coverage: the share of its characters inside known words (of 4 to 8 letters);
  * path: depth, and whether it names tests, examples or documentation;
  * neighbours: the word before and the word after, hashed, a secret-like name before it, an
    assignment sign and quotes.
The forest is trained from labelled findings: any frame of (candidate, before, after, path,
label).  ``seed_findings`` makes such a frame, by ``candidates`` over generated lines, of known
kinds of secrets and of false positives where no reviewed findings are at hand.

Everything runs in the JVM: regular expressions, higher-order functions, joins and the forest.

Defined cases: a null or empty text has no candidates; a null path counts as empty; repeated
rows each have their findings; two equal candidates in a text are two findings; a table without
candidates gives no rows; only the id, text and path columns are read (``redacted`` keeps the
others); a row is redacted by the values found in it alone, wherever they stand in it, so that rows
without an id and rows that share one don't touch each other.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import written

_CLASS = r"A-Za-z0-9+/=_\-"
#: Name and sign of an assignment that starts a run.
_ASSIGNS = r"[A-Za-z_][A-Za-z0-9_\-]{0,63}="
#: Names that assign secrets, in any case, and what stands between them and the value.
SECRET_NAME = (r"(?i:passw(?:or)?d|passphrase|passwd|pwd|secret|token|api[_\-]?key|apikey|access[_\-]?key|private[_\-]?key|"
               r"auth|credentials?|bearer)")
_SIGN = r"[\w\-]{0,24}[\"']?[ \t]{0,4}(?::=|=>|=|:)[ \t]{0,4}"
_LEAD = rf"(?<={SECRET_NAME}{_SIGN}"
CANDIDATE = "|".join([
    *[rf"(?<={q}){_LEAD}{q})[^{q}\r\n]{{6,256}}+(?={q})" for q in "\"'`"],
    rf"(?<=[=:> \t])(?<=[=:>][ \t]{{0,4}}){_LEAD})[^\s\"'`,;()\[\]{{}}<>=:][^\s\"'`,;()\[\]{{}}<>]{{5,255}}+(?![^\s\"'`,;()\[\]{{}}<>])",
    rf"(?<==)(?<=(?<![{_CLASS}]){_ASSIGNS})[{_CLASS}]{{16,}}+",
    rf"(?<![{_CLASS}])(?=[{_CLASS}]{{16}})(?![A-Za-z_][A-Za-z0-9_\-]{{0,63}}+=[A-Za-z0-9+/_\-])[{_CLASS}]{{16,}}+"])
#: Every text with a candidate matches one of these, which cost less than CANDIDATE.
_GATES = (rf"(?<![{_CLASS}])[{_CLASS}]{{16}}", rf"(?=[psatcbPSATCB]){SECRET_NAME}{_SIGN}")
#: Characters kept on either side of a candidate.
CONTEXT = 64
WORD_SIZES = range(4, 9)
NEIGHBOURS = 64
_NUMBERS = ["n_chars", "digits", "upper", "lower", "marks", "distinct", "changes", "odds", "covered", "depth",
            "tests", "named", "assigned", "quoted"]
MASK = "[SECRET]"


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               path_col: str | None = None) -> DataFrame:
    """(id, path, start, candidate, before, after) of every candidate; start counts characters from 0.

    ``before`` and ``after`` reach no further than the neighbouring candidates.
    """
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    rows = (docs.select(F.col(id_col).alias("id"), path.alias("path"), F.col(text_col).cast("string").alias("text"))
            .filter(F.col("text").rlike(_GATES[0]) | F.col("text").rlike(_GATES[1])).filter(F.col("text").rlike(CANDIDATE)))
    cut = rows.select("id", "path", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("hits"),
                      F.split("text", CANDIDATE, -1).alias("gaps"))
    # gaps[i] stands before hits[i] and gaps[i + 1] after it
    near = cut.select("id", "path", "hits",
                      F.transform("gaps", lambda g: F.struct(F.length(g).alias("n"), F.right(g, F.lit(CONTEXT)).alias("tail"),
                                                             F.left(g, F.lit(CONTEXT)).alias("head"))).alias("gaps"))
    found = near.select("id", "path", F.posexplode(F.arrays_zip(
        F.col("hits").alias("hit"), F.slice("gaps", F.lit(1), F.size("hits")).alias("left"),
        F.slice("gaps", F.lit(2), F.size("hits")).alias("right"), _starts().alias("start"))).alias("n", "z"))
    return found.select("id", "path", F.col("z.start").alias("start"), F.col("z.hit").alias("candidate"),
                        F.col("z.left.tail").alias("before"), F.col("z.right.head").alias("after"))


def _starts():
    """Start of every hit: all gaps up to it and all hits before it."""
    pairs = F.zip_with("hits", F.slice("gaps", F.lit(1), F.size("hits")),
                       lambda h, g: F.struct(F.length(h).cast("long").alias("h"), g["n"].cast("long").alias("g")))
    first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(pairs, first,
                       lambda acc, p: F.struct((acc["at"] + p["g"] + p["h"]).alias("at"),
                                               F.array_append(acc["out"], acc["at"] + p["g"]).alias("out")),
                       lambda acc: acc["out"])


def _share(pattern: str):
    return F.length(F.regexp_replace("candidate", pattern, "")) / F.col("n_chars")


def _transitions(values: DataFrame) -> DataFrame:
    """(candidate, pair): two neighbouring characters, one row each; letters lower-cased, digits as 0, rare signs as ~."""
    plain = F.regexp_replace(F.regexp_replace(F.lower("candidate"), "[0-9]", "0"), r"[^a-z0+/=_\-]", "~")
    return values.select("candidate", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("candidate") - 1), lambda i: F.substr(plain, i, F.lit(2)))).alias("pair"))


def transition_odds(findings: DataFrame) -> DataFrame:
    """(pair, odds): log-odds of a transition in labelled secrets against false positives; 40 * 40 rows at most."""
    labelled = findings.select("candidate", "label").distinct()
    pairs = _transitions(labelled).join(labelled, "candidate")
    table = pairs.groupBy("pair").agg(F.sum(F.col("label") * 1.0).alias("yes"), F.sum(1.0 - F.col("label")).alias("no"))
    total = table.agg(F.sum("yes").alias("all_yes"), F.sum("no").alias("all_no"))
    return table.join(F.broadcast(total)).select(  # total is one row
        "pair", F.ln(((F.col("yes") + 1) / (F.col("all_yes") + 1600)) / ((F.col("no") + 1) / (F.col("all_no") + 1600))).alias("odds"))


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(word): lower-case words of 4 to 8 letters in a public tokenizer's vocabulary file."""
    file = spark.read.schema("model struct<vocab: map<string, int>>").json(path, multiLine=True)
    word = F.regexp_replace("key", "^Ġ", "")
    return (file.select(F.explode("model.vocab").alias("key", "id")).select(word.alias("word"))
            .filter(F.col("word").rlike(rf"^[a-z]{{{WORD_SIZES[0]},{WORD_SIZES[-1]}}}$")).distinct())


def _coverage(values: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(candidate, covered): the share of characters that stand in a word of the dictionary."""
    def runs(k):
        starts = F.slice(F.sequence(F.lit(1), F.length("candidate")), F.lit(1), F.greatest(F.length("candidate") - (k - 1), F.lit(0)))
        return F.transform(starts, lambda i: F.struct(i.alias("at"), F.substr(F.lower("candidate"), i, F.lit(k)).alias("word")))

    parts = [runs(k) for k in WORD_SIZES]
    spans = values.select("candidate", F.inline(F.concat(*parts))).filter(F.col("word").rlike("^[a-z]+$"))
    inside = spans.join(dictionary, "word").select(
        "candidate", F.explode(F.sequence("at", F.col("at") + F.length("word") - 1)).alias("at"))
    return inside.groupBy("candidate").agg((F.countDistinct("at") / F.length("candidate")).alias("covered"))


def features(found: DataFrame, odds: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``found`` with one column per feature.  Equal candidates are measured once."""
    values = found.select("candidate").distinct()
    mean = (_transitions(values).join(F.broadcast(odds), "pair", "left")  # at most 40 * 40 rows
            .groupBy("candidate").agg(F.avg(F.coalesce("odds", F.lit(0.0))).alias("odds")))
    kinds = F.regexp_replace("candidate", "[^A-Za-z0-9]", "-")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(kinds, "[0-9]+", "0"), "[A-Z]+", "A"), "[a-z]+", "a")
    measured = (values.join(mean, "candidate", "left").join(_coverage(values, dictionary), "candidate", "left")
                .withColumn("n_chars", F.length("candidate").cast("double"))
                .select("candidate", "n_chars", _share("[^0-9]").alias("digits"), _share("[^A-Z]").alias("upper"),
                        _share("[^a-z]").alias("lower"), _share("[A-Za-z0-9]").alias("marks"),
                        (F.size(F.array_distinct(F.split("candidate", ""))) / F.col("n_chars")).alias("distinct"),
                        ((F.length(kinds) - 1) / (F.col("n_chars") - 1)).alias("changes"),
                        F.coalesce("odds", F.lit(0.0)).alias("odds"), F.coalesce("covered", F.lit(0.0)).alias("covered")))
    path = F.lower("path")
    return found.join(measured, "candidate").select(
        found["*"], *[c for c in measured.columns if c != "candidate"],
        F.size(F.split(path, "/")).cast("double").alias("depth"),
        path.rlike("test|example|sample|fixture|mock|docs?/|readme").cast("double").alias("tests"),
        F.col("before").rlike(rf"{SECRET_NAME}[\w\-]*\W*$").cast("double").alias("named"),
        F.col("before").rlike(r"(?:[=:]|=>)\s*[\"'`]?$").cast("double").alias("assigned"),
        (F.col("before").rlike(r"[\"'`]$") & F.col("after").rlike(r"^[\"'`]")).cast("double").alias("quoted"),
        F.lower(F.regexp_extract("before", r"(\w+)\W*$", 1)).alias("word_before"),
        F.lower(F.regexp_extract("after", r"^\W*(\w+)", 1)).alias("word_after"))


def _vectors(rows: DataFrame) -> DataFrame:
    words = FeatureHasher(inputCols=["word_before"], outputCol="words", numFeatures=NEIGHBOURS)
    after = FeatureHasher(inputCols=["word_after"], outputCol="words_after", numFeatures=NEIGHBOURS)
    joined = VectorAssembler(inputCols=[*_NUMBERS, "words", "words_after"], outputCol="features")
    return joined.transform(after.transform(words.transform(rows)))


class SecretModel:
    """A trained forest with the tables its features need."""

    def __init__(self, forest: RandomForestClassificationModel, odds: DataFrame, dictionary: DataFrame):
        self.forest, self.odds, self.dictionary = forest, odds, dictionary

    def findings(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None,
                 threshold: float = 0.5) -> DataFrame:
        """(id, start, candidate, score, secret) of every candidate of every row."""
        rows = _vectors(features(candidates(docs, id_col, text_col, path_col), self.odds, self.dictionary))
        score = vector_to_array("probability")[1]
        return self.forest.transform(rows).select(
            F.col("id").alias(id_col), "start", "candidate", score.alias("score"),
            (score >= threshold).cast("int").alias("secret"))


def train(findings: DataFrame, dictionary: DataFrame, trees: int = 30, depth: int = 8, seed: int = 11) -> SecretModel:
    """Fit on labelled findings; they are reviewed by people, so few, and their features are written once."""
    odds = written(transition_odds(findings), "transitions")
    rows = written(features(findings, odds, dictionary).withColumn("label", F.col("label").cast("double")), "findings")
    rows = _vectors(rows).select("features", "label")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird",
                                    probabilityCol="probability").fit(rows)
    return SecretModel(forest, odds, dictionary)


def seed_findings(spark: SparkSession, dictionary: DataFrame, n: int = 4096) -> DataFrame:
    """Labelled findings of known kinds, ``n`` rows: what reviewers mark as secrets and as false positives.

    Secrets are random keys and passwords that a name like token or password assigns; false positives are joined
    words, identifiers, file paths, long numbers, rulers, hashes that a word like commit or checksum
    introduces, and placeholders and plain words that such a name assigns.  Rows come from
    ``candidates`` over whole lines, so training and scan see one form; lines whose value is no
    candidate give none.
    """
    def pick(salt: int, values: list[str]):
        return F.element_at(F.array(*map(F.lit, values)), (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(values))) + 1).cast("int"))

    some = dictionary.orderBy(F.xxhash64("word"), "word").limit(2048).agg(F.sort_array(F.collect_list("word")).alias("words"))
    base = spark.range(n).join(F.broadcast(some))  # one row of 2048 words
    raw = F.concat(F.sha2(F.concat(F.lit("a"), F.col("id")), 256), F.sha2(F.concat(F.lit("b"), F.col("id")), 256))
    mixed = F.translate(F.base64(F.unhex(raw)), "\r\n", "")
    hexes = F.substr(raw, F.lit(1), pick(1, ["20", "24", "32", "32", "40", "40", "40", "48", "64"]).cast("int"))
    key = (F.when(F.col("id") % 4 < 2, hexes)
           .when(F.col("id") % 4 == 2, F.substr(mixed, F.lit(1), pick(2, ["20", "24", "32", "40", "44", "64"]).cast("int")))
           .otherwise(F.concat(pick(3, ["AKIA", "ghp_", "sk-", "xox-"]), F.substr(F.translate(mixed, "+/", "ab"), F.lit(1), F.lit(28)))))
    name = pick(4, ["token", "secret", "password", "passwd", "api_key", "apikey", "key", "access_key", "auth", "credential", "bearer",
                    "client_secret", "private_key", "pwd", "API_KEY", "DB_PASSWORD", "AWS_SECRET_ACCESS_KEY", "db_password", "authToken"])
    sign = pick(5, [" = ", "=", ": ", " := ", "=", " "])
    quote = pick(6, ['"', "'", '"', ""])
    words = [F.element_at("words", (F.pmod(F.xxhash64("id", F.lit(40 + k)), F.size("words")) + 1).cast("int")) for k in range(5)]
    digits = F.regexp_replace(F.translate(raw, "abcdef", "012345"), "^0+", "1")
    # passwords: a word, digits and a sign, or a short random run
    tail = F.concat(F.substr(digits, F.lit(1), pick(13, ["1", "2", "4", "4"]).cast("int")), pick(14, ["!", "", "?", "#", "$", "@", ""]))
    password = (F.when(F.col("id") % 3 == 0, F.concat(F.initcap(words[0]), tail)).when(F.col("id") % 3 == 1, F.concat(words[0], tail, words[0], tail))
                .otherwise(F.substr(mixed, F.lit(1), pick(15, ["8", "10", "12", "14"]).cast("int"))))
    short = F.xxhash64("id", F.lit(16)) % 4 == 0
    benign = (F.when(F.col("id") % 16 < 5, F.concat(*words[:4]))
              .when(F.col("id") % 16 == 5, F.concat(F.initcap(words[0]), F.initcap(words[1]), F.initcap(words[2]), F.initcap(words[3])))
              .when(F.col("id") % 16 == 6, F.concat_ws("_", *words[:4]))
              .when(F.col("id") % 16 == 7, F.concat_ws("/", *words))
              .when(F.col("id") % 16 == 8, F.concat_ws("-", *words[:4]))
              .when(F.col("id") % 16 < 11, F.substr(digits, F.lit(1), F.lit(16)))
              .when(F.col("id") % 16 == 11, F.when(F.xxhash64("id", F.lit(17)) % 2 == 0, words[0]).otherwise(F.concat_ws(".", words[0], words[1])))
              .when(F.col("id") % 16 == 12, F.repeat(pick(7, ["x", "-", "=", "*", "_", "0", "X"]), F.lit(24)))
              .when(F.col("id") % 16 == 13, pick(8, ["your_api_key_here", "insert-token-here", "example_password_1", "CHANGE_ME_CHANGE_ME",
                                                     "changeme", "${PASSWORD}", "required", "xxxxxxxx", "********", "config.password"]))
              .otherwise(F.substr(raw, F.lit(1), pick(9, ["32", "40", "64"]).cast("int"))))
    hashed = F.col("id") % 16 >= 14
    told = pick(10, ["commit", "checksum", "md5", "sha1", "sha256", "digest", "etag", "revision", "hash", "uuid"])
    assigned = (F.col("id") % 16).isin(11, 13)
    secret = F.xxhash64("id") % 2 == 0
    value = F.when(secret, F.when(short, password).otherwise(key)).otherwise(benign)
    lead = F.when(secret | assigned, F.concat(words[4], F.lit(" "), name, sign, quote)).when(
        hashed, F.concat(words[4], F.lit(" "), told, pick(11, [" ", ": ", "=", " is "]))).otherwise(F.concat(words[4], F.lit(" ")))
    close = F.when(secret | assigned, quote).otherwise(F.lit(""))
    paths = ["src/app/main", "src0", "config/settings", "docs/readme", "tests/fixtures/data", ""]
    # placeholders stand mostly in tests and documentation; elsewhere the path tells nothing
    path = F.when(~secret & (F.col("id") % 16 == 13) & (F.xxhash64("id", F.lit(18)) % 4 != 0), pick(12, paths[3:5])).otherwise(pick(12, paths))
    lines = written(base.select(
        "id", F.concat(lead, value, close, F.lit(" "), words[3]).alias("line"), path.alias("path"), value.alias("value"),
        secret.cast("int").alias("label")), "seed-lines")
    found = candidates(lines, "id", "line", "path").join(lines.select("id", "value", "label"), "id").filter(F.col("candidate") == F.col("value"))
    return written(found.select("candidate", "before", "after", "path", "label"), "seed-findings")


def redacted(docs: DataFrame, model: SecretModel, id_col: str = "doc_id", text_col: str = "text",
             path_col: str | None = None, length_col: str | None = None) -> DataFrame:
    """``docs`` with every secret replaced by ``MASK``; other columns stay, ``length_col`` is counted anew."""
    path = F.col(path_col).cast("string") if path_col else F.lit("")
    # rows with equal keys have equal ids, texts and paths, and so equal findings
    key = F.sha2(F.to_json(F.struct(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"), path.alias("p"))), 256)
    keyed = docs.withColumn("__key", key)
    found = model.findings(keyed, "__key", text_col, path_col).filter("secret = 1")
    by_row = found.groupBy(F.col("__key").alias("__row")).agg(F.collect_set("candidate").alias("__found"))
    longest = F.array_sort("__found", lambda a, b: F.coalesce(F.nullif(F.length(b) - F.length(a), F.lit(0)),
                                                               F.when(a < b, -1).when(a > b, 1).otherwise(0)))
    # one pass, so that nothing is replaced inside a mask
    any_of = F.array_join(F.transform(longest, lambda s: F.concat(
        F.lit("\\Q"), F.replace(s, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))), "|")
    text = F.when(F.col("__found").isNull(), F.col(text_col)).otherwise(F.regexp_replace(F.col(text_col), any_of, F.lit(MASK)))
    out = keyed.join(by_row, F.col("__key") == F.col("__row"), "left").withColumn(text_col, text)
    if length_col:
        out = out.withColumn(length_col, F.when(F.col("__found").isNull(), F.col(length_col))
                             .otherwise(F.length(text_col).cast(docs.schema[length_col].dataType)))
    return out.select(docs.columns)
