r"""Secret scans: candidates by form, false positives removed by a random forest.  DataFrame functions and Spark ML only.

Every white-space delimited word is cut at quotes, brackets and ``? & ; , = : | \`` into parts; a part after ``name=`` or
``name:`` has that name.  *Candidates* are the parts' runs of the alphabet of keys with at least ``least_chars`` characters, a
digit among them or 16 capitals in a row, all that begin as a known issuer's keys do, and whatever a credential's name is given
to (a whole part, with any characters and of any length); there can be several in a word.
Its *features*:

* length, the shares of digits, capitals and hexadecimal characters, and whether it begins as a known issuer's keys do;
* character transitions: changes between lower case, capitals, digits and marks, and letter pairs vowel/consonant;
* dictionary coverage: the share of its characters in common words;
* path: slashes, dots and file endings in the word, and whether it is a URL;
* neighbouring words: whether the assigned name or the words before and after speak of credentials, or of numbers, addresses
  and checksums that only look like one.

The forest is trained from labelled findings: a table the caller has, or :func:`label_by_form`, which labels the candidates
whose issuer's form or plain shape leaves no doubt and leaves out the rest.  Training takes at most ``fit_findings`` findings
(lowest hashes); every candidate is scored."""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.session import cut_lineage

#: Words that speak of a credential, and words that speak of what only looks like one.
CREDENTIAL_WORDS = r"(?i)(key|token|secret|passw|pwd|credential|auth|bearer|api|private)"
HARMLESS_WORDS = r"(?i)(phone|tel|call|card|visa|address|host|server|commit|sha|md5|hash|checksum|uuid|version|isbn|order|invoice|serial|example|sample|test|dummy)"
#: Common words, for dictionary coverage.
DICTIONARY = r"(?i)(password|secret|token|example|sample|change|default|admin|user|login|public|private|server|client|value|string|number|version|order|your|this|that|with|from|have|here|name|test|demo|dummy|null|none|true|false|index|image|file|page|http|html|data|code)"
#: Forms of well-known issuers, and plain shapes of other things.
ISSUED = r"^(AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|xox[abpr]-[0-9A-Za-z-]{10,}|sk_live_[0-9A-Za-z]{16,}|AIza[0-9A-Za-z_-]{35}|eyJ[0-9A-Za-z_-]{10,}\.[0-9A-Za-z_-]+\.[0-9A-Za-z_-]*)$"
PLAIN = r"^([0-9.+/:_-]+|[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}|.*\.(com|org|net|html?|php|jpe?g|png|gif|pdf|txt|csv|js|css)([/?#].*)?)$"
DELIMITERS = r"""[\s"'`()\[\]{}<>?&;,=:|\\]"""
PARTS = rf"{DELIMITERS}+|{DELIMITERS.replace('[', '[^', 1)}+"
RUN = r"[A-Za-z0-9+/_.~@-]*[A-Za-z0-9+/_~-]"
FOLLOWS = r"""(?i)(key|token|secret|passw|pwd)\w*["']?\s*[=:]+>?\s*["'`(\[{<]*$"""
PREFIX = r"^(AKIA|ASIA|gh[pousr]_|xox[abpr]-|sk_live_|AIza|eyJ)"
KEY_LIKE = r"[0-9]|[A-Z]{16}"
FEATURES = ["chars", "digits", "capitals", "hexadecimal", "issuer_prefix", "changes", "vowel_pairs", "distinct", "dictionary", "slashes", "dots", "file_ending", "url", "assigned", "named_credential", "before_credential", "before_harmless", "after_harmless"]


def candidates(docs: DataFrame, least_chars: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``key`` (hash of the text), ``word`` (its number in the text, from 0), ``value``, and the features."""
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), F.split(text, r"\s+").alias("words"))
    each = rows.select("doc_id", "key", "words", F.posexplode("words").alias("word", "token"))
    token, before_it = F.col("token"), F.get("words", F.col("word") - 1)
    before = F.concat_ws(" ", F.get("words", F.col("word") - 3), F.get("words", F.col("word") - 2), before_it)
    given = (before_it.rlike(r"""[=:>]["'`(\[{<]*$""") | token.rlike("^[=:]")) & F.concat_ws(" ", before, F.regexp_extract(token, rf"^{DELIMITERS}*", 0)).rlike(FOLLOWS)
    each = each.where(((F.length("token") >= least_chars) & token.rlike(KEY_LIKE)) | token.rlike(PREFIX[1:]) | (token.rlike("[=:]") & token.rlike(CREDENTIAL_WORDS)) | F.coalesce(given, F.lit(False)))
    near = each.select("doc_id", "key", "word", before.alias("before"), F.coalesce(F.get("words", F.col("word") + 1), F.lit("")).alias("after"), F.coalesce(given, F.lit(False)).alias("given"), F.regexp_extract_all("token", F.lit(PARTS), F.lit(0)).alias("parts"))
    near = near.select("*", F.posexplode("parts").alias("part", "run")).where(~F.col("run").rlike(f"^{DELIMITERS}"))
    ahead, behind = (F.coalesce(F.get("parts", F.col("part") + k), F.lit("")) for k in (-1, 1))
    name = F.when(ahead.rlike("[=:]") & ~F.col("run").startswith("//"), F.coalesce(F.get("parts", F.col("part") - 2), F.lit(""))).otherwise("")
    quoted = ahead.rlike("""["'`]$""") & behind.rlike("""^=*["'`]""")
    padding = F.when(quoted | behind.rlike("^=+$"), F.regexp_extract(behind, "^={0,2}", 0)).otherwise("")
    near = near.select("doc_id", "key", "word", "before", "after", "run", name.alias("name"), (F.col("given") & (F.col("part") <= 1)).alias("follows"), quoted.alias("quoted"), padding.alias("padding"))
    near = near.withColumn("credential", F.col("follows") | F.col("name").rlike(CREDENTIAL_WORDS))
    whole = F.when(F.col("quoted"), F.col("run")).otherwise(F.regexp_replace("run", "[^A-Za-z0-9+/_~-]+$", ""))
    values = F.when(F.col("credential"), F.array(F.concat(whole, "padding"))).otherwise(F.transform(F.regexp_extract_all("run", F.lit(RUN), F.lit(0)), lambda v: F.when(F.col("run").endswith(v), F.concat(v, "padding")).otherwise(v)))
    near = near.select("*", F.explode(values).alias("value"))
    found = near.where(((F.length("value") >= least_chars) & F.col("value").rlike(KEY_LIKE)) | F.col("value").rlike(PREFIX) | (F.col("credential") & (F.col("value") != "")))
    value, n = F.col("value"), F.length("value")

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / n

    return found.select(
        "doc_id", "key", "word", "value", "name", "before", "follows",
        n.cast("double").alias("chars"), share("[0-9]").alias("digits"), share("[A-Z]").alias("capitals"), share("[0-9a-f]").alias("hexadecimal"), value.rlike(PREFIX).cast("double").alias("issuer_prefix"),
        share("[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9])").alias("changes"), share("(?i)[aeiou](?=[bcdfghjklmnpqrstvwxyz])").alias("vowel_pairs"),
        (F.size(F.array_distinct(F.split(value, ""))) / n).alias("distinct"), (1 - F.length(F.regexp_replace(value, DICTIONARY, "")) / n).alias("dictionary"),
        F.regexp_count(value, F.lit("/")).cast("double").alias("slashes"), F.regexp_count(value, F.lit("[.]")).cast("double").alias("dots"),
        value.rlike(r"\.[A-Za-z]{2,4}$").cast("double").alias("file_ending"), F.col("run").rlike("(?i)^(//|www[.])").cast("double").alias("url"),
        (F.length("name") > 0).cast("double").alias("assigned"), F.col("name").rlike(CREDENTIAL_WORDS).cast("double").alias("named_credential"),
        F.col("before").rlike(CREDENTIAL_WORDS).cast("double").alias("before_credential"), F.col("before").rlike(HARMLESS_WORDS).cast("double").alias("before_harmless"),
        F.col("after").rlike(HARMLESS_WORDS).cast("double").alias("after_harmless"),
    )


def label_by_form(found: DataFrame) -> DataFrame:
    """Labelled findings: 1 for an issuer's form, or for a value of mixed characters that is assigned to (or follows) a
    credential's name; 0 for plain shapes (numbers, addresses, file names, letters alone) and dictionary words; others are left
    out."""
    named = (F.col("named_credential") == 1) | F.col("follows")
    issued = F.col("value").rlike(ISSUED)
    secret = named & F.col("value").rlike("[0-9!#$%]") & (F.col("digits") < 1) & (F.col("dictionary") < 0.3) & (F.col("distinct") * F.col("chars") >= 6)
    harmless = F.col("value").rlike(PLAIN) | F.col("value").rlike("^[A-Za-z]+$") | (F.col("dictionary") > 0.6)
    return found.withColumn("label", F.when(issued, 1.0).when(harmless, 0.0).when(secret, 1.0)).where("label is not null")


def train(labelled: DataFrame, fit_findings: int = 20_000, trees: int = 30, depth: int = 8, seed: int = 7) -> RandomForestClassificationModel | float:
    """A forest on at most ``fit_findings`` rows (features and ``label``); with one class or none, that class."""
    sample = labelled.orderBy(F.xxhash64("doc_id", "word", "value"), "doc_id", "word").limit(fit_findings).select("label", *FEATURES)
    sample = cut_lineage(sample, "findings")  # read by the count, the split search and the fit
    counts = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(counts) < 2:
        return next(iter(counts), 0.0)
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, labelCol="label").fit(ready)


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """``doc_id``, ``key``, ``word``, ``value``, ``probability``: the findings that the forest keeps.

    ``labelled``: findings with the features and ``label``; by default the documents' own, labelled by form.  NULL and empty
    texts have no findings; repeated rows give repeated findings; NULL ids are kept; with no labelled findings nothing is
    kept (there is nothing to tell a secret by)."""
    found = candidates(docs, id_col=id_col, text_col=text_col)
    model = train(label_by_form(found) if labelled is None else labelled, **limits)
    if isinstance(model, float):
        scored = found.withColumn("probability", F.lit(model))
    else:
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)).withColumn("probability", vector_to_array("probability")[1])
    return scored.where(F.col("probability") >= threshold).select("doc_id", "key", "word", "value", "probability")


def redact(docs: DataFrame, mark: str = "[SECRET]", id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", **options) -> DataFrame:
    """``docs`` with every kept finding's value replaced by ``mark`` in the text; ``length_col``, if there is one, follows.
    All rows and columns stay."""
    values = scan(docs, id_col=id_col, text_col=text_col, **options).groupBy("doc_id", "key").agg(F.transform(F.sort_array(F.collect_set(F.struct(F.length("value").alias("n"), "value")), asc=False), lambda v: v["value"]).alias("values"))
    values = values.toDF("found_id", "found_key", "found")
    names = [f"c{k}" for k in range(len(docs.columns))]  # columns of docs may have any names
    own = docs.toDF(*names)
    text = own[names[docs.columns.index(text_col)]].cast("string")
    doc_id = own[names[docs.columns.index(id_col)]].cast("long")
    joined = own.join(values, doc_id.eqNullSafe(values["found_id"]) & (F.xxhash64(text) == values["found_key"]), "left")
    clean = F.when(F.col("found").isNull(), text).otherwise(F.aggregate("found", text, lambda t, v: F.regexp_replace(t, F.concat(F.lit(r"(?<![A-Za-z0-9])\Q"), v, F.lit(r"\E(?![A-Za-z0-9])")), F.lit(re.sub(r"([$\\])", r"\\\1", mark)))))
    length = F.when(F.col("found").isNull(), F.col(names[docs.columns.index(length_col)])).otherwise(F.length(clean)) if length_col in docs.columns else None
    columns = [clean if c == text_col else length.cast(docs.schema[c].dataType) if c == length_col else F.col(n) for c, n in zip(docs.columns, names)]
    return joined.select(*[column.alias(n) for column, n in zip(columns, names)]).toDF(*docs.columns)
