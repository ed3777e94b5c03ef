"""Secret scans with a random forest against false positives (operator 5), in built-in expressions only.

Candidates are long runs of letters, digits and the signs of keys, and whatever is assigned (``=`` or ``:``) to
a telling name, at any length and with any signs: inside quotes up to the closing one, else up to a blank,
quote or angle bracket, or a ``,``, ``;`` or ``&`` that begins another assignment, without the signs ``. : ? )
] }`` at the end. Each is described by its length and kinds of characters, transitions between these and between vowels and
consonants, the part of it that dictionary words cover, formats of known issuers, the path of the document and
the neighbouring words. A random forest trained from labelled findings tells secrets from other tokens (card
and serial numbers, names of files, hashes in links, ordinary words after a telling name); findings below the
threshold stay in the result with ``is_secret`` false.

Labels come with the findings. Where a corpus has none, ``weak_labels`` makes them from formats of known
issuers and from values assigned to telling names that do not look like words, counts or placeholders; then a
known issuer's format stands whatever the forest says. The forest is fitted on at most ``SAMPLE_ROWS`` labelled
findings (a documented bound): equally many of every kind (label, known issuer, assigned or not) at most, those
with the smallest hash, so that rare kinds are all kept. The dictionary has all words next to candidates, of all
documents, that stand there ``WORD_COUNT`` times or more; runs of letters inside values are joined with it.

Equal texts of equal path have the same findings, so findings are made once per distinct text: copies meet
in partial aggregates by digest, and documents get theirs by a join on it.

Defined cases: null texts have no findings and are not changed; a null path is an empty one; without
labelled findings, or with labels of one kind only, every finding takes that kind (none: no secret); texts
are scanned whole; repeated rows give repeated results; ids may be null; other columns stay as they are.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import settle

# fixed values: candidates, telling names, paths of examples, known issuers
SIGNS = "A-Za-z0-9+/_-"
PADDING = r"(?:={1,2}(?![^\s\"'`<>.,;:)\]}]))?"
LONG_RUN = f"(?<![{SIGNS}])(?:(?=[A-Za-z+/_-]{{0,40}}[0-9])[{SIGNS}]{{12,}}|[{SIGNS}]{{24,}}){PADDING}"
NAMES = r"(?i)(passw(or)?d|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|bearer|private)"
ASSIGNED = r"[=:]\s*[\"']?$"
PASSWORDS = "passphrase|password|passwd|pwd"
TELLING = (f"(?i:{PASSWORDS}|secret|token|api[_-]?key|access[_-]?key|auth[_-]?key|private[_-]?key|credential)"
           r"(?:s|[_-][\w-]{0,20}|[A-Z0-9]\w{0,20})?")
GIVEN = r"[\"'`]?[ \t]{0,3}(?:[=:]{1,2}|[=:]>)[ \t]{0,3}"
PART = r"[^\s\"'`<>,;&]"
ASSIGNED_VALUE = (rf"(?<=[=:>][ \t]{{0,3}}[\"'`]?)(?<={TELLING}{GIVEN}[\"'`]?)(?:"
                  + "|".join(rf"(?<={q})[^{q}\r\n]+(?={q})" for q in "\"'`")
                  + rf"|(?<![^=:> \t\"'`])(?![=:>]){PART}+(?:[,;&](?![\w.-]{{1,40}}[ \t]?[=:]){PART}+){{0,8}}(?<![.:?)\]}}]))")
CANDIDATE = f"(?:{ASSIGNED_VALUE}|{LONG_RUN})"
NAMED = rf"{TELLING}{GIVEN}[\"'`]?$"
PASSWORD_NAMED = rf"(?i:{PASSWORDS}){GIVEN}[\"'`]?$"
#: Values after telling names that are taken for words, counts or placeholders where labels are made by rule.
PLAIN = r"(?i)^([a-z]{1,15}|\*+|x{3,}|\.+|<.*|[$%]?[{(\[].*|\$\w+|%\w+%|[\w.]+[(\[].*)$"
#: A part between blanks that is neither a word nor a number, up to a sign at its end.
NO_WORD = r"(?:^|\s)(?!(?:[A-Za-z']+|[0-9]+)[,.;:!?]?(?:\s|$))\S"
COUNT = r"^[0-9.,]+$"
EXAMPLE_PATH = r"(?i)(test|example|sample|fixture|demo|mock|doc)"
LOCK_PATH = r"(?i)(lock|sum|min|map|svg|csv)"
ISSUERS = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})$"
SAMPLE_ROWS, WORD_COUNT, THRESHOLD, TREES, DEPTH = 20_000, 5, 0.5, 20, 6
BEFORE, AFTER = 60, 20
MASK = "[SECRET]"
FEATURES = ["length", "digits", "upper", "lower", "signs", "changes", "vowel_steps", "distinct", "hex", "covered",
            "issuer", "example_path", "lock_path", "telling_name", "named", "assigned", "quoted", "number_before", "links"]


def text_key(text: Column, path: Column) -> Column:
    path = F.coalesce(path, F.lit(""))
    return F.md5(F.concat(F.length(path).cast("string"), F.lit(" "), path, text).cast("binary"))


def find_candidates(docs: DataFrame, *, text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """``key, start, end, value, before, after, path``: one row per candidate of each distinct text.

    ``start`` and ``end`` are offsets in characters (code points).
    """
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col in docs.columns else F.lit("")
    text = docs.select(F.col(text_col).alias("text"), path.alias("path")).where(F.col("text").rlike(CANDIDATE))
    cut = text.select(text_key(F.col("text"), F.col("path")).alias("key"), "path",
                      F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("values"),
                      F.split("text", CANDIDATE).alias("gaps"))
    places = cut.select("key", "path", "gaps", "values", F.posexplode("values").alias("k", "value")).select(
        "key", "k", F.struct(
            "value", "path", F.length(F.get("gaps", F.col("k"))).alias("gap"),
            F.right(F.concat(F.coalesce(F.get("values", F.col("k") - 1), F.lit("")), F.get("gaps", F.col("k"))), F.lit(BEFORE)).alias("before"),
            F.left(F.get("gaps", F.col("k") + 1), F.lit(AFTER)).alias("after")).alias("found"))
    # copies of a text give equal rows, of which partial aggregates keep one
    once = places.groupBy("key", "k").agg(F.first("found").alias("found"))
    so_far = Window.partitionBy("key").orderBy("k")
    length = F.length("found.value")
    end = F.sum(F.col("found.gap") + length).over(so_far)
    return once.select("key", (end - length).alias("start"), end.alias("end"), "found.value", "found.before",
                       "found.after", "found.path")


def dictionary(candidates: DataFrame, least: int = WORD_COUNT) -> DataFrame:
    """``word``: words of three letters or more that stand next to candidates ``least`` times or more."""
    near = candidates.select(F.explode(F.regexp_extract_all(
        F.lower(F.concat_ws(" ", "before", "after")), F.lit(r"(?<![a-z0-9])[a-z]{3,}(?![a-z0-9])"), F.lit(0))).alias("word"))
    return near.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("word")


def covered(candidates: DataFrame, words: DataFrame) -> DataFrame:
    """``candidates`` with ``covered``: the part of the value in runs of letters that are words of the dictionary."""
    runs = candidates.select("value").distinct().select("value", F.explode(F.regexp_extract_all(
        "value", F.lit("[A-Z]?[a-z]{2,}|[A-Z]{3,}(?![a-z])"), F.lit(0))).alias("run")).withColumn("word", F.lower("run"))
    known = runs.join(words, "word", "left_semi").groupBy("value").agg(F.sum(F.length("run")).alias("letters"))
    return candidates.join(known, "value", "left").withColumn(
        "covered", F.coalesce(F.col("letters") / F.length("value"), F.lit(0.0))).drop("letters")


def featured(candidates: DataFrame, words: DataFrame) -> DataFrame:
    candidates = covered(candidates, words)
    value, low = F.col("value"), F.lower("value")
    size = F.length(value)
    share = lambda pattern, of=value: F.regexp_count(of, F.lit(pattern)) / size
    flag = lambda test: test.cast("double")
    return candidates.select(
        "*", size.cast("double").alias("length"), share("[0-9]").alias("digits"), share("[A-Z]").alias("upper"),
        share("[a-z]").alias("lower"), share("[^A-Za-z0-9]").alias("signs"),
        share("(?<=[0-9])(?=[^0-9])|(?<=[^0-9])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])").alias("changes"),
        share("(?<=[aeiou])(?=[b-df-hj-np-tv-z])|(?<=[b-df-hj-np-tv-z])(?=[aeiou])", low).alias("vowel_steps"),
        (F.size(F.array_distinct(F.split(value, ""))) / size).alias("distinct"),
        flag(value.rlike("^[0-9a-f]+$|^[0-9A-F]+$")).alias("hex"),
        flag(value.rlike(ISSUERS)).alias("issuer"), flag(F.col("before").rlike(NAMED)).alias("named"),
        flag(F.col("path").rlike(EXAMPLE_PATH)).alias("example_path"), flag(F.col("path").rlike(LOCK_PATH)).alias("lock_path"),
        flag(F.col("before").rlike(NAMES)).alias("telling_name"), flag(F.col("before").rlike(ASSIGNED)).alias("assigned"),
        flag(F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")).alias("quoted"),
        flag(F.col("before").rlike(r"[0-9]\s$")).alias("number_before"),
        flag(F.col("before").rlike(r"(://|www\.|@|/)\S*$")).alias("links"))


def weak_labels(findings: DataFrame) -> DataFrame:
    """Adds ``label``: 1 for known issuers and for assignments to telling names, but for plain words, sentences, counts and
    placeholders, else 0. A number counts as a secret only after a name for passwords."""
    value, before = F.col("value"), F.col("before")
    return findings.withColumn("label", (
        value.rlike(ISSUERS) | (before.rlike(NAMED) & ~value.rlike(PLAIN)
                                & (~value.rlike(r"\s") | value.rlike(NO_WORD)) & (~value.rlike(COUNT) | before.rlike(PASSWORD_NAMED)))
    ).cast("double"))


class Forest:
    """A fitted forest, or one kind for all where the labels know no other."""

    def __init__(self, model=None, kind: float = 0.0):
        self.model, self.kind = model, kind

    def score(self, findings: DataFrame) -> DataFrame:
        if self.model is None:
            return findings.withColumn("score", F.lit(self.kind))
        rows = VectorAssembler(inputCols=FEATURES, outputCol="__features").transform(findings)
        scored = self.model.transform(rows)
        return scored.withColumn("score", vector_to_array("__probability")[1]).drop(
            "__features", "__probability", "__raw", "__prediction")


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Forest:
    """A forest from featured findings with ``label`` 0 or 1; rows without a label are left out."""
    rows = labelled.where("label is not null").select(*FEATURES, F.col("label").cast("double"), F.xxhash64("key", "start").alias("rank"))
    # ranks within a kind: Spark keeps the first of each task before it moves rows
    of_kind = Window.partitionBy("label", "issuer", "named").orderBy("rank", *FEATURES)
    sample = settle(rows.withColumn("place", F.row_number().over(of_kind)).where(F.col("place") <= sample_rows // 8).drop("place", "rank"),
                    "labelled-findings")
    kinds = sorted(r[0] for r in sample.select("label").distinct().collect())
    if len(kinds) < 2:
        return Forest(kind=kinds[0] if kinds else 0.0)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="__features").transform(sample)
    return Forest(RandomForestClassifier(
        featuresCol="__features", labelCol="label", probabilityCol="__probability", rawPredictionCol="__raw",
        predictionCol="__prediction", numTrees=TREES, maxDepth=DEPTH, seed=7).fit(rows))


def scan_texts(docs: DataFrame, *, text_col: str = "text", path_col: str | None = "source", forest: Forest | None = None,
               threshold: float = THRESHOLD) -> DataFrame:
    """Findings of each distinct text with ``score`` and ``is_secret``; trains from weak labels if no forest is given."""
    candidates = settle(find_candidates(docs, text_col=text_col, path_col=path_col), "candidates")
    findings = featured(candidates, dictionary(candidates))
    sure = F.col("issuer") == 1 if forest is None else F.lit(False)
    forest = forest or train(weak_labels(findings))
    return forest.score(findings).select("key", "start", "end", "value", "score", ((F.col("score") >= threshold) | sure).alias("is_secret"))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source",
         forest: Forest | None = None) -> DataFrame:
    """``doc_id, start, end, value_sha256, score, is_secret``: one row per finding of each document."""
    found = settle(scan_texts(docs, text_col=text_col, path_col=path_col, forest=forest), "findings")
    path = F.col(path_col) if path_col in docs.columns else F.lit("")
    ids = docs.where(F.col(text_col).rlike(CANDIDATE)).select(
        F.col(id_col).alias("doc_id"), text_key(F.col(text_col), path.cast("string")).alias("key"))
    return ids.join(found, "key").select(
        "doc_id", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"),
        F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), F.round("score", 6).alias("score"), "is_secret")


def redact(docs: DataFrame, *, text_col: str = "text", path_col: str | None = "source", forest: Forest | None = None,
           mask: str = MASK) -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mask``; texts without candidates do not move."""
    found = scan_texts(docs, text_col=text_col, path_col=path_col, forest=forest).where("is_secret")
    spans = settle(found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end", F.lit(0).alias("of")))).alias("spans")), "secret-spans")
    path = F.col(path_col) if path_col in docs.columns else F.lit("")
    suspect = F.coalesce(F.col(text_col).rlike(CANDIDATE), F.lit(False))
    names = docs.columns
    keyed = docs.where(suspect).withColumn("__key", text_key(F.col(text_col), path.cast("string")))
    spans = spans.select(F.col("key").alias("__key"), F.col("spans").alias("__spans"))
    text, cuts = F.col(text_col), F.col("__spans")

    def piece(span, k):
        after = F.when(k > 0, F.get(cuts, k - 1)["end"]).otherwise(F.lit(0))
        return F.concat(F.substring(text, (after + 1).cast("int"), (span["start"] - after).cast("int")), F.lit(mask))
    last = F.element_at(cuts, -1)["end"]
    clean = F.concat(F.array_join(F.transform(cuts, piece), ""), F.substring(text, (last + 1).cast("int"), F.length(text)))
    changed = keyed.join(spans, "__key", "left").withColumn(text_col, F.when(cuts.isNull(), text).otherwise(clean)).select(*names)
    return docs.where(~suspect).unionByName(changed)
