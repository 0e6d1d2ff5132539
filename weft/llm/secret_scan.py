"""Secret scanning: pattern candidates, with a random forest that removes
false findings.

``candidates`` takes every run of 16 or more key-like characters, and every
value of ``SHORTEST`` or more characters of any kind that a credential's name
and a separator precede, with the text before and after it.  ``features``
describes length, character transitions, coverage by dictionary words, path
characters and the neighbouring words.

The forest (Spark ML) learns from labelled findings whose labels do not come
from its features: findings planted by ``planted``, so that what they are is
known (random keys, passwords and issued formats as secrets; digests, UUIDs,
numbers, paths, words and placeholders as none; every kind in several
neighbourhoods), and runs without digits found in the texts, which are words.
The neighbouring words that count are chosen among those of the labelled
findings.  The verdict on every candidate is the forest's.  ``labelled`` tells
by rule what some candidates of the texts are; the forest never sees it, the
tests hold its verdicts against it.  Letter pairs and dictionary are counted
over all documents.

Everything is DataFrame, SQL or Spark ML.  Scale: one pass over the texts
counts words (partial sums before the shuffle), one finds the candidates (a
few bytes in a thousand go on); the fit sees a bounded sample (``Fit``);
``redact`` moves texts once, to meet their findings.

Defined results: null and empty texts have no candidates; repeated rows are
scanned each; the forest exists on any corpus, an empty one included; findings
of a null doc_id are returned; ``redact`` masks in each row the secrets found
in its own text, with or without doc_id: one of ``LONG`` characters wherever
it stands, a shorter one after a credential's name; other columns pass,
whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import doc_texts, stored

CANDIDATE = r"[A-Za-z0-9_+/\-]{16,}={0,2}"
LONG = 16  # characters of a value that is no word of a text by chance
SHORTEST = 4  # characters of a value after a name
NEAR = 48  # characters kept on either side
AROUND = NEAR // SHORTEST  # candidates that NEAR characters hold at most
BLOCK = 256  # candidates of a text in one sum

# Words that name a credential, and formats of issued keys.
NAMES = r"(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|private[_-]?key|bearer)"
ASSIGNED = NAMES + r"""["']?\s*(?:[:=]|=>|is)?\s*["']?$"""
AFTER_NAME = r"""(?<=(?i:%s)["']?\s{0,8}(?:=>|:=|[:=])\s{0,8}["']?)""" % NAMES
# within quotes all up to the closing one, else without punctuation at the end; a place is looked at from its
# last character to the name, as most are none
NAMED = (
    r"""(?<=[:=>\s"'])(?<=[:=>]\s{0,8}["']?)""" + AFTER_NAME
    + r"""(?:(?<=")[^\s"]{4,}|(?<=')[^\s']{4,}|(?<!["'])[^\s"':=>]\S{2,}[^\s"'.,;)\]}])"""
)
FOUND = NAMED + "|" + CANDIDATE
FORMATS = (
    r"^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[abpr]-[A-Za-z0-9-]{10,}$"
    r"|^sk_(?:live|test)_[A-Za-z0-9]{16,}$|^AIza[A-Za-z0-9_-]{35}$"
)
# Forms of values with digits that are no secret unless a name precedes them.
DIGEST_WORDS = r"(?:commit|revision|rev|sha-?\d*|md5|digest|checksum|hash|blob|tree|parent|etag)[^a-z0-9]{0,8}$"
DIGEST = r"^[0-9a-f]{16,128}$"
UUID = r"^(?i:[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12})$"
FILE_PATH = r"^/{0,2}(?:[a-z0-9_-]+/){2,}[a-z0-9_-]*$"
NUMBER = r"^[0-9+/_-]+$"

LETTERS = "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["f_length", "f_upper", "f_changes", "f_distinct", "f_transitions", "f_rare", "f_words", "f_path", "f_other", "f_after"]
# What is planted: names of credentials with what stands between them and the value, and other neighbours.
CREDENTIALS = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key", "auth_token",
               "credential", "private_key", "client_secret", "aws_secret_access_key", "db_password", "bearer")
SEPARATORS = ("=", " = ", ": ", ":", '="', ' = "', ": '", "='", " => ")
DIGEST_NEIGHBOURS = ("commit ", "sha256: ", "md5 ", "checksum: ", 'etag: "', "tree ", "revision ", "hash ", "digest=", "blob/")
ID_NEIGHBOURS = ("id=", "uuid ", "request ", "row ", "session: ", "trace ")
ISSUED = ("AKIA", "ASIA", "ghp_", "gho_", "xoxb-", "sk_live_", "sk_test_", "AIza")  # how issued keys begin
SETTING_WORDS = ("access", "api", "auth", "client", "credential", "example", "key", "password", "placeholder", "private",
                 "required", "secret", "token", "undefined", "your")
PLACEHOLDERS = ("null", "none", "true", "false", "example", "changeme", "your_api_key", "xxxxxxxxxxxx", "required",
                "undefined", "password", "placeholder", "redacted", "********")


@dataclass(frozen=True)
class Fit:
    """Bounds of what the classifier is fitted on."""

    planted: int = 8000
    found: int = 3000  # words found in the texts
    share: float = 3e-4  # of all words, from which a word is in the dictionary: at most 1 / share words
    neighbours: int = 30
    trees: int = 30
    depth: int = 12


def _ends(text: Column) -> Column:
    """All that NEAR characters from either side can reach."""
    return F.when(F.length(text) > 2 * NEAR, F.concat(F.left(text, F.lit(NEAR)), F.right(text, F.lit(NEAR)))).otherwise(
        text)


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, nth, start, value, before, after): every candidate with its
    place in characters from 0."""
    some = doc_texts(docs).where(F.col("text").rlike(FOUND))
    cut = some.select(
        "doc_id", F.regexp_extract_all("text", F.lit(FOUND), F.lit(0)).alias("_v"),
        F.split("text", FOUND, -1).alias("_between"))
    # ends are running sums in two levels, so a text of n candidates costs n * BLOCK steps, not n * n
    zero = F.lit(0).cast("long")
    cut = cut.withColumn("_steps", F.transform(
        "_v", lambda v, i: (F.length(F.get("_between", i)) + F.length(v)).cast("long")))
    cut = cut.withColumn("_sums", F.transform(
        F.sequence(F.lit(0), ((F.size("_steps") - 1) / BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice("_steps", b * BLOCK + 1, F.lit(BLOCK)), zero, lambda t, n: t + n)))
    cut = cut.withColumn("_heads", F.transform(
        "_sums", lambda _, b: F.aggregate(F.slice("_sums", F.lit(1), b), zero, lambda t, n: t + n)))
    # what is between the candidates and they themselves in turn, of each the two ends
    cut = cut.withColumn("_near", F.flatten(F.transform("_between", lambda t, i: F.array(
        _ends(t), _ends(F.coalesce(F.get("_v", i), F.lit("")))))))
    one = cut.select("doc_id", "_near", "_steps", "_heads", F.posexplode("_v").alias("nth", "value"))
    block = (F.col("nth") / BLOCK).cast("int")
    end = F.get("_heads", block) + F.aggregate(
        F.slice("_steps", block * BLOCK + 1, F.col("nth") % BLOCK + 1), zero, lambda t, n: t + n)
    first = F.greatest(F.lit(1), 2 * F.col("nth") + 1 - 2 * AROUND)
    return one.select(
        "doc_id", "nth", (end - F.length("value")).alias("start"), "value",
        F.right(F.concat_ws("", F.slice("_near", first, 2 * F.col("nth") + 2 - first)), F.lit(NEAR)).alias("before"),
        F.left(F.concat_ws("", F.slice("_near", 2 * F.col("nth") + 3, F.lit(2 * AROUND + 1))), F.lit(NEAR))
        .alias("after"))


@dataclass(frozen=True)
class Prose:
    """What ordinary words look like: for each pair of letters how usual it
    is (a digit 0 to 9 at 26 * first + second), and the commonest words."""

    pairs: str
    words: tuple[str, ...]


def learn_prose(docs: DataFrame, fit: Fit) -> Prose:
    """Letter pairs and dictionary of all documents."""
    words = docs.select(F.explode(F.regexp_extract_all(
        F.lower("text"), F.lit("(?<![a-z0-9])[a-z]{2,12}(?![a-z0-9])"), F.lit(0))).alias("w"))
    counted = stored(words.groupBy("w").count(), "prose-words")
    pair = counted.select(F.explode(F.transform(
        F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substr("w", i, F.lit(2)))).alias("p"), "count")
    n = {r.p: r.n for r in pair.groupBy("p").agg(F.sum("count").alias("n")).collect()}
    total = counted.agg(F.sum("count")).first()[0] or 0
    common = counted.where((F.length("w") >= 3) & (F.col("count") >= fit.share * total)).collect()
    cells = []
    for a in LETTERS:
        of_a = sum(n.get(a + b, 0) for b in LETTERS)
        cells += [min(9, int(60 * n.get(a + b, 0) / of_a)) if of_a else 0 for b in LETTERS]
    return Prose("".join(map(str, cells)), tuple(sorted((r.w for r in common), key=lambda w: (-len(w), w))))


def planted(spark: SparkSession, prose: Prose, fit: Fit) -> DataFrame:
    """(value, before, after, label) of findings made up for training."""
    def seed(salt: str) -> Column:
        return F.sha2(F.concat_ws(":", F.col("id").cast("string"), F.lit(salt)), 256)

    def pick(salt: str, among) -> Column:
        at = F.conv(F.substring(seed(salt), 1, 7), 16, 10).cast("int") % len(among)
        return F.get(F.array(*[F.lit(x) for x in among]), at)

    def size(salt: str, low: int, high: int) -> Column:
        return F.conv(F.substring(seed(salt), 1, 7), 16, 10).cast("int") % (high - low + 1) + low

    def cut_to(text: Column, n: Column | int) -> Column:
        return F.substr(text, F.lit(1), n if isinstance(n, Column) else F.lit(n))

    hexes = F.concat(seed("x"), seed("y"))
    mixed = F.regexp_replace(F.base64(F.unhex(hexes)), "[+/=\\s]", "")
    issued = F.concat(pick("kind", ISSUED), cut_to(mixed, size("n9", 16, 36)))

    def constant(name: Column) -> Column:  # the name of a setting, often with the sign behind it
        return F.concat(F.when(F.col("id") % 4 < 2, F.upper(name)).otherwise(name), F.when(F.col("id") % 3 > 0, "=").otherwise(""))

    letters = F.translate(hexes, "0123456789abcdef", "aeioulnrstmdpcgb")
    digits = F.translate(hexes, "abcdef", "012345")
    uuid = F.concat_ws("-", *[F.substring(hexes, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    common = prose.words or ("the", "and", "for")
    word = [pick(f"w{i}", common) for i in range(6)]
    symbols = F.concat(cut_to(mixed, size("n1", 2, 6)), pick("sym", ("!", "#", "$", "%", "&", ".", "-", "@")),
                       F.substring(mixed, 20, 3))
    name = F.concat(pick("name", CREDENTIALS), pick("sep", SEPARATORS))
    name = F.when(F.col("id") % 3 == 0, F.upper(name)).otherwise(name)
    prose_before, path = pick("end", (" ", ", ", ". ", "(", " | ", ""),), F.concat(
        pick("root", ("/usr/lib", "src/main", "home/user", "/var/log", "docs/api")), F.substring(digits, 3, 2), F.lit("/"),
        word[2], F.lit("/"), word[3], F.lit("_"), F.substring(digits, 1, 1))
    # (value, neighbourhood, label), each for an equal share of the rows
    kinds = [
        (cut_to(hexes, size("n2", 16, 64)), name, 1), (cut_to(mixed, size("n3", 16, 44)), name, 1),
        (cut_to(letters, size("n4", 8, 28)), name, 1), (symbols, name, 1),
        (cut_to(mixed, size("n5", 4, 15)), name, 1), (cut_to(hexes, 40), name, 1),
        (issued, prose_before, 1), (F.upper(issued), prose_before, 1), (issued, name, 1),
        (cut_to(hexes, F.element_at(F.array(F.lit(32), F.lit(40), F.lit(64)), size("n6", 1, 3))),
         pick("dig", DIGEST_NEIGHBOURS), 0),
        (uuid, F.when(F.col("id") % 2 == 0, pick("ids", ID_NEIGHBOURS)).otherwise(prose_before), 0),
        (cut_to(digits, size("n7", 16, 24)), prose_before, 0), (path, prose_before, 0),
        (F.concat(*word[:4]), prose_before, 0), (pick("hold", PLACEHOLDERS), name, 0),
        (cut_to(letters, size("n8", 16, 24)), prose_before, 0), (F.concat_ws("-", *word[:4]), prose_before, 0),
        (constant(F.concat_ws("_", pick("c1", CREDENTIALS), pick("c2", CREDENTIALS))), prose_before, 0),
        (constant(F.concat_ws("_", *word[:4])), prose_before, 0),
    ]
    rows = spark.range(fit.planted).withColumn("_kind", (F.col("id") % len(kinds)).cast("int"))
    value = before = label = None
    for k, (v, b, y) in enumerate(kinds):
        is_k = F.col("_kind") == k
        value, before, label = ((F.when(is_k, x) if old is None else old.when(is_k, x))
                                for old, x in ((value, v), (before, b), (label, F.lit(float(y)))))
    made = rows.select("id", value.alias("value"), before.alias("near"), label.alias("label"), *[
        w.alias(f"w{i}") for i, w in enumerate(word)])
    quote = F.when(F.col("near").endswith('"'), '"').when(F.col("near").endswith("'"), "'").otherwise("")
    return made.select("value", F.right(F.concat("w4", F.lit(" "), "w5", F.lit(" "), "near"), F.lit(NEAR)).alias("before"),
                       F.concat(quote, F.lit(" "), "w4").alias("after"), "label").where(F.length("value") >= SHORTEST)


def _neighbours() -> Column:
    """The last three words before a value and the first two after it."""
    def words(text: str) -> Column:
        return F.regexp_extract_all(F.lower(text), F.lit("[a-z]+[0-9]*"), F.lit(0))

    last = F.reverse(words("before"))
    return F.concat(F.slice(last, F.lit(1), F.lit(3)), F.transform(
        F.slice(words("after"), F.lit(1), F.lit(2)), lambda w: F.concat(F.lit(">"), w)))


def chosen_neighbours(sample: DataFrame, fit: Fit) -> list[str]:
    """The neighbouring words that best tell the labels of the sample apart."""
    per = sample.select("label", F.explode(F.array_distinct(_neighbours())).alias("w")).groupBy("w").agg(
        F.sum("label").alias("yes"), F.sum(1 - F.col("label")).alias("no"))
    odds = F.abs(F.log((F.col("yes") + 1) / (F.col("no") + 1))) * F.sqrt(F.col("yes") + F.col("no"))
    return [r.w for r in per.orderBy(F.desc(odds), "w").limit(fit.neighbours).collect()]


def features(found: DataFrame, prose: Prose, neighbours: list[str]) -> DataFrame:
    """``found`` with the columns FEATURES and one per neighbouring word."""
    low = F.lower("value")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    runs = F.length(F.regexp_replace(kinds, r"(.)\1+", "$1"))
    # pairs of a letter and the next: how usual they are in prose, 0 to 9
    letters = F.left(F.regexp_replace(low, "[^a-z]", ""), F.lit(64))
    steps = F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(letters) - 1)),
        lambda i: F.substr(F.lit(prose.pairs), (F.ascii(F.substr(letters, i, F.lit(1))) - 97) * 26
                           + F.ascii(F.substr(letters, i + 1, F.lit(1))) - 96, F.lit(1)).try_cast("double"))
    usual = F.aggregate(steps, F.lit(0.0), lambda t, x: t + F.coalesce(x, F.lit(0.0)))
    rare = F.size(F.filter(steps, lambda x: F.coalesce(x, F.lit(0.0)) == 0))
    paired = F.length(letters) >= 2
    words = sorted({*prose.words, *SETTING_WORDS}, key=lambda w: (-len(w), w))
    rest = F.length(F.regexp_replace(low, "|".join(words), ""))
    close = _neighbours()
    return found.withColumns({
        "f_length": F.least(F.length("value"), F.lit(200)).cast("double"),
        "f_upper": F.length(F.regexp_replace("value", "[^A-Z]", "")) / F.length("value"),
        "f_changes": runs / F.length("value"),
        "f_distinct": F.size(F.array_distinct(F.split(F.left("value", F.lit(64)), ""))).cast("double"),
        "f_transitions": F.when(paired, usual / (F.length(letters) - 1)).otherwise(0.0),
        "f_rare": F.when(paired, rare / (F.length(letters) - 1)).otherwise(1.0),
        "f_words": F.lit(1.0) - rest / F.length("value"),
        "f_path": F.length(F.regexp_replace("value", "[^/_-]", "")) / F.length("value"),
        "f_other": F.length(F.regexp_replace("value", "[A-Za-z]", "")) / F.length("value"),
        "f_after": F.col("before").rlike("""[:=>]\\s*["']?$""").cast("double"),
        **{f"n_{i}": F.array_contains(close, w).cast("double") for i, w in enumerate(neighbours)},
    })


def labelled() -> Column:
    """1 for a certain secret, 0 for what is certainly none, else null."""
    value, assigned = F.col("value"), F.lower("before").rlike(ASSIGNED)
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    secret = value.rlike(FORMATS) | (mixed & assigned)
    digest = F.lower("before").rlike(DIGEST_WORDS) & F.lower(value).rlike(DIGEST)
    none = ~value.rlike("[0-9]") | digest | value.rlike("|".join((UUID, FILE_PATH, NUMBER)))
    return F.when(secret, 1.0).when(none & ~assigned, 0.0)


def _words_found(found: DataFrame, fit: Fit) -> DataFrame:
    """Of the runs without digits that follow no separator, a bounded sample:
    words, no secrets."""
    plain = found.where(F.col("value").rlike("^[A-Za-z]+$") & ~F.col("before").rlike("""[:=>"']\\s*$"""))
    n = plain.count()
    pick = F.pmod(F.xxhash64("doc_id", "nth", "value"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return plain.where(pick < fit.found / max(1, n)).limit(2 * fit.found).select(
        "value", "before", "after", F.lit(0.0).alias("label"))


def scan(docs: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """Candidates with the forest's score and verdict: (doc_id, nth, start,
    value, score, is_secret)."""
    found = stored(candidates(docs), "secret-candidates")
    prose = learn_prose(docs, fit)
    sample = stored(planted(docs.sparkSession, prose, fit).unionByName(_words_found(found, fit)), "secret-sample")
    neighbours = chosen_neighbours(sample, fit)
    columns = [*FEATURES, *[f"n_{i}" for i in range(len(neighbours))]]
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=fit.trees,
                                    maxDepth=fit.depth, seed=4)
    model = Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="features"), forest]).fit(
        features(sample, prose, neighbours).select("label", *columns))
    scored = model.transform(features(found, prose, neighbours))
    return scored.select("doc_id", "nth", "start", "value", vector_to_array("probability")[1].alias("score")).withColumn(
        "is_secret", F.col("score") > 0.5)


def redact(docs: DataFrame, fit: Fit = Fit(), mask: str = "[SECRET]") -> DataFrame:
    """The documents, all kept, with their secrets masked; ``n_chars`` follows
    the text where there is such a column."""
    # by text, so a doc_id that many rows share (or lack) is no group
    of = F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))
    values = scan(docs.select(of.alias("doc_id"), "text"), fit).where("is_secret").groupBy(F.col("doc_id").alias("of")).agg(
        F.array_sort(F.collect_set("value"), lambda a, b: F.length(b) - F.length(a)).alias("values"))
    # the row as one column, so that its names meet no other
    rows = docs.select(F.struct(*docs.columns).alias("doc"), of.alias("key"))
    joined = rows.join(stored(values, "secrets"), F.col("key") == F.col("of"), "left")
    plain = mask.replace("\\", "\\\\").replace("$", "\\$")

    def masked(t: Column, v: Column) -> Column:
        quoted = F.concat(F.lit(AFTER_NAME + r"\Q"), F.replace(v, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
        return F.when(F.length(v) < LONG, F.regexp_replace(t, quoted, F.lit(plain))).otherwise(
            F.replace(t, v, F.lit(mask)))

    text = F.col("doc.text")
    clean = F.when(F.col("values").isNull(), text).otherwise(F.aggregate("values", text, masked))
    changed = {"text": clean}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("values").isNull(), F.col("doc.n_chars")).otherwise(F.length(clean)).cast(
            docs.schema["n_chars"].dataType)
    return joined.select(*[changed.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
