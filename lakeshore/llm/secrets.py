"""Secret scans: a random forest removes false positives among candidate strings. DataFrame and MLlib functions only."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, dealt_anew, dropped, fresh_path

#: A candidate: so many characters at least of these; or so many of a value after a name and = or :, of which a digit or a sign is one.
LEAST_CHARS, LEAST_VALUE = 16, 6
_CHAR, _VALUE = r"[A-Za-z0-9+/_=.~-]", r"[A-Za-z0-9+/_=.~!@#$%^&*?-]"
_NAMED = r"^[A-Za-z_.-]{1,30}="
_ASSIGNED = r"[A-Za-z_.-][\"']?\s{0,3}[=:]\s{0,3}[\"']?"
PATTERN = rf"(?<!{_CHAR})(?:[A-Za-z_.-]{{1,30}}={_VALUE}{{{LEAST_VALUE},}}|(?<={_ASSIGNED})(?=[A-Za-z_.-]{{0,40}}[0-9!@#$%^&*?+/~]){_VALUE}{{{LEAST_VALUE},}}|{_CHAR}{{{LEAST_CHARS},}})"
#: Its context: the word before it, and what stands between; at most CONTEXT characters.
_BEFORE, CONTEXT = r"(?i)(?:\S{1,40}\s{1,3})?(?:\S{0,40}?\s{0,3}[=:]\s{0,3}[\"']?)?$", 100
#: Words from which labels are made: before an assigned secret, and before a public digest or number.
_SECRET, _PUBLIC = r"(?:token|secret|passw|pwd|api.?key|access.?key|auth|credential)\S{0,20}", r"(?:sha\d*|md5|commit|digest|checksum|hash|uuid|etag|revision|version|isbn|fingerprint)\S{0,4}"
_SECRET_WORDS, _PUBLIC_WORDS = rf"(?i){_SECRET}\s{{0,3}}[=:]\s{{0,3}}[\"']?$", rf"(?i){_PUBLIC}\s{{0,3}}[=: ]?\s{{0,3}}[\"']?$"
#: Host and file names, paths from a root, mail addresses, numbers and dates: forms that are plainly public.
_PUBLIC_FORM = r"^(?:(?:[A-Za-z0-9_-]+[./])+[a-z]{2,6}|[.~]?/{1,2}(?:[A-Za-z0-9_.-]+/)+[A-Za-z0-9_.-]*|[^@]+@[^@]+\.[A-Za-z]{2,}|[0-9.,+/-]+|[0-9]{4}-[0-9]{2}-[0-9]{2}\S*)$"
#: Providers' formats, of which the form alone tells a secret.
_KNOWN = r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk_live_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)$"

# Stands around candidates while a text is cut: a private character, which is none of a candidate's.
_MARK = "\ue000"
#: Contexts in which findings of a public form are fitted too: their form counts, whatever stands before them.
_CONTEXTS = ['token = "', "token: ", 'secret = "', "secret: ", "password=", "password: ", "api_key=", "auth: "]

#: At most so many labelled findings of each label are fitted, those of which there are most, then by hash.
MOST_LABELS = 5_000
#: So many parts of the hashes of neighbouring words are features.
BUCKETS = 64
FEATURES = ["length", "transitions", "digits", "capitals", "signs", "distinct", "hexadecimal", "numeric", "dictionary", "slashes", "dots", "path", "assigned", "quoted", *(f"word_{k}" for k in range(BUCKETS))]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, place, candidate, before): each candidate of each text, its number in the text, and the words before it.

    Null and empty texts have none; null and repeated ids pass through; a text of any length is searched whole.
    """
    # The pattern runs once over a text: what it finds is set between marks, at which the text is then split.
    text = F.translate(F.col(text_col), _MARK, " ")
    marked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.regexp_replace(text, f"({PATTERN})", f"{_MARK}$1{_MARK}").alias("marked"))
    cut = marked.where(F.col("marked").contains(_MARK)).select("doc_id", F.split("marked", _MARK, -1).alias("every"))
    odd = lambda k: F.expr(f"filter(every, (x, i) -> i % 2 = {k})")
    cut = cut.select("doc_id", odd(1).alias("found"), odd(0).alias("parts"))
    # The context may hold candidates itself, two at most as it has two words at most.
    near = f"right(concat(if(i > 1, found[i - 2], ''), if(i > 0, right(parts[i - 1], {CONTEXT}), ''), if(i > 0, found[i - 1], ''), right(parts[i], {CONTEXT})), {CONTEXT})"
    every = cut.select("doc_id", F.posexplode(F.expr(f"transform(found, (x, i) -> struct(x, {near} AS near))")).alias("place", "match"))
    every = every.select("doc_id", "place", F.col("match.x").alias("x"), F.regexp_extract("match.near", _BEFORE, 0).alias("before"))
    # A form as key=value, without a break, is cut at its sign.
    value = F.regexp_replace("x", rf"{_NAMED}(?=.{{{LEAST_VALUE},}}$)", "")
    before = F.concat("before", F.expr("substring(x, 1, length(x) - n)"))
    cut = every.withColumn("n", F.length(value)).select("doc_id", "place", F.regexp_replace(value, r"[.=]+$", "").alias("candidate"), before.alias("before"))
    return cut.where(F.length("candidate") >= LEAST_VALUE)


def label(candidate: Column, before: Column) -> Column:
    """1 for a finding that its format or an assignment tells to be a secret, 0 for one that is plainly none.

    Null where nothing tells, and where the words before it and its form tell different things: that is left to the forest.
    """
    letters, form = ~candidate.rlike("[^A-Za-z_.-]"), candidate.rlike(_PUBLIC_FORM)
    secret, public = before.rlike(_SECRET_WORDS), before.rlike(_PUBLIC_WORDS) | before.rlike("@$")
    # A public form is none even where a secret's word stands before it; that isn't labelled, so that the forest has to tell.
    one = candidate.rlike(_KNOWN) | (secret & ~public & ~letters & ~form)
    return F.when(one, 1).when((letters | form | public) & ~secret, 0)


def is_fitted(candidate: Column) -> Column:
    """Whether the labels of a candidate may be fitted: a hashed half; the other half shows how well the forest judges."""
    return F.pmod(F.xxhash64(candidate), F.lit(2)) == 0


def without_evidence(before: Column) -> Column:
    """The words before a finding without those that labels are made from, and without the sign of an assignment."""
    bare = F.regexp_replace(before, rf"(?i){_SECRET}|{_PUBLIC}", "")
    return F.regexp_replace(bare, r"\s{0,3}[=:]?\s{0,3}[\"']?$", " ")


def dictionary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(trigram, share): every letter trigram of the words of all documents, and the logarithm of its count as a share of the largest one."""
    words = docs.select(F.explode(F.split(F.lower(text_col), r"[^\p{L}]+")).alias("word")).where("length(word) >= 3")
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    trigrams = counts.select(F.explode(F.expr("transform(sequence(1, length(word) - 2), i -> substring(word, i, 3))")).alias("trigram"), "n")
    summed = checkpointed(trigrams.groupBy("trigram").agg(F.log1p(F.sum("n")).alias("n")))
    most = summed.agg(F.max("n")).first()[0] or 1.0
    return summed.select("trigram", (F.col("n") / most).alias("share"))


def with_features(found: DataFrame, known: DataFrame) -> DataFrame:
    """Features of distinct (candidate, before): length, character transitions, dictionary coverage, path and neighbouring words."""
    c, before = F.col("candidate"), F.col("before")
    n = F.length(c)
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]", "a"), "[A-Z]", "B"), "[0-9]", "0"), "[^aB0]", "-")
    share = lambda pattern: F.regexp_count(c, F.lit(pattern)) / n
    word = F.lower(F.regexp_extract(before, r"(\w+)\W*$", 1))
    bucket = F.when(word == "", -1).otherwise(F.pmod(F.xxhash64(word), F.lit(BUCKETS)))
    trigram = F.explode(F.expr("transform(sequence(1, greatest(1, length(candidate) - 2)), i -> substring(lower(candidate), i, 3))"))
    # Each candidate's trigrams meet the dictionary in a join; sums combine before the shuffle.
    parts = found.select("candidate").distinct().select("candidate", trigram.alias("trigram"))
    covered = parts.join(known, "trigram", "left").groupBy("candidate").agg(F.avg(F.coalesce("share", F.lit(0.0))).alias("dictionary"))
    return found.join(covered, "candidate").select(
        *found.columns,
        n.cast("double").alias("length"),
        ((F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1) / n).alias("transitions"),
        share("[0-9]").alias("digits"),
        share("[A-Z]").alias("capitals"),
        share(r"[!@#$%^&*?~]").alias("signs"),
        (F.size(F.array_distinct(F.split(c, ""))) / n).alias("distinct"),
        c.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$").cast("double").alias("hexadecimal"),
        c.rlike("^[0-9.-]+$").cast("double").alias("numeric"),
        "dictionary",
        share("/").alias("slashes"),
        share(r"\.").alias("dots"),
        (c.rlike(r"/|\.\w{1,4}$") | before.rlike(r"(?:://|/)\S*$")).cast("double").alias("path"),
        before.rlike(r"[=:]\s{0,3}[\"']?$").cast("double").alias("assigned"),
        before.rlike(r"[\"']$").cast("double").alias("quoted"),
        *[(bucket == k).cast("double").alias(f"word_{k}") for k in range(BUCKETS)],
    )


def _vectors(features: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep").transform(features)


def labelled(kinds: DataFrame, most_labels: int = MOST_LABELS) -> DataFrame:
    """(candidate, before, label, weight): labelled findings of the fitted half, most_labels of each label at most.

    Each stands there twice, as it is and without the evidence for its label, so that the forest learns what findings
    look like apart from the words that labels are made from. Those that are public by their form stand there once more,
    with the words of a secret before them.
    """
    told = kinds.withColumn("label", label(F.col("candidate"), F.col("before")).cast("double")).where(F.col("label").isNotNull() & is_fitted(F.col("candidate")))
    # What many findings are like counts more, so that a frequent look-alike of few forms isn't missed.
    told = told.select("candidate", "before", "label", (F.log1p("n_findings") if "n_findings" in told.columns else F.lit(1.0)).alias("weight"))
    order = [F.desc("weight"), F.xxhash64("candidate", "before"), F.col("candidate"), F.col("before")]
    sample = checkpointed(told.where("label = 1").orderBy(*order).limit(most_labels).unionByName(told.where("label = 0").orderBy(*order).limit(most_labels)))
    plain = sample.where((F.col("label") == 0) & (F.col("candidate").rlike(_PUBLIC_FORM) | ~F.col("candidate").rlike("[^A-Za-z_.-]")))
    other = F.element_at(F.array(*map(F.lit, _CONTEXTS)), 1 + F.pmod(F.xxhash64("before", "candidate"), F.lit(len(_CONTEXTS))).cast("int"))
    bare = sample.withColumn("before", without_evidence(F.col("before")))
    return sample.unionByName(bare).unionByName(plain.withColumn("before", other))


def fit(kinds: DataFrame, known: DataFrame, most_labels: int = MOST_LABELS) -> RandomForestClassificationModel | None:
    """A forest fitted to the labelled findings among kinds(candidate, before); None without both labels."""
    sample = labelled(kinds, most_labels)
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=32, maxDepth=12, seed=7, featureSubsetStrategy="onethird", featuresCol="features", labelCol="label", weightCol="weight")
    fitted = forest.fit(_vectors(with_features(sample, known)).select("features", "label", "weight"))
    # A fitted model holds its training summary, and with it the session, which executors can't be sent once an Observation
    # is in it. A saved model that is loaded again has none.
    path = fresh_path(kinds.sparkSession, "forest")
    fitted.write().save(path)
    loaded = RandomForestClassificationModel.load(path)
    dropped(kinds.sparkSession, path)
    return loaded


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_labels: int = MOST_LABELS) -> DataFrame:
    """(doc_id, place, candidate, before, label, score, is_secret) of every candidate of every text; is_secret if score > 0.5: of what the forest is undecided about nothing is kept.

    The score is the forest's alone, for labelled findings too. Without labels of both kinds it is 1 for findings that
    are labelled secrets and 0 for others. Null and empty texts have no candidates; null and repeated ids pass through, each
    row with its own; other columns are ignored; an empty table gives no rows. A text of any length is searched whole. Of
    equally frequent labelled findings those with the smallest hashes are fitted.
    """
    found = checkpointed(candidates(docs, id_col, text_col))
    kinds = checkpointed(found.groupBy("candidate", "before").agg(F.count("*").alias("n_findings")))
    known = dictionary(docs, text_col)
    told = label(F.col("candidate"), F.col("before")).alias("label")
    model = fit(kinds, known, most_labels)
    if model is None:
        scored = kinds.select("candidate", "before", told, F.coalesce(told, F.lit(0)).cast("double").alias("score"))
    else:
        judged = model.transform(_vectors(with_features(kinds, known)))
        scored = judged.select("candidate", "before", told, vector_to_array("probability")[1].alias("score"))
    joined = found.join(dealt_anew(scored, "candidate"), ["candidate", "before"])
    return joined.select("doc_id", "place", "candidate", "before", "label", "score", (F.col("score") > 0.5).alias("is_secret"))
