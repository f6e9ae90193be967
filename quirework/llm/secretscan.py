"""Secret scans: candidates by pattern, false positives removed by a random forest; SQL functions and Spark ML only.

A candidate is a run of 16 or more of the characters that keys are made of, wherever it stands, or what is assigned to a
password. Its features are its length, the transitions between its characters under a model counted from the corpus, how much of it
words of the corpus cover, the path it stands in, and the words around it. The forest is trained from labelled findings: rows
(lead, candidate, tail, label).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.common import renamed, table

#: What keys are made of, and what is assigned to a password; the second comes first.
KEY = r"[A-Za-z0-9_+/-]{16,}={0,2}"
PASSWORD = r"((?i:password|passwd|passphrase|pwd|secret)[\"']?\s?[:=]\s?[\"']?)([^\s\"'<>,;\x02]{6,})"
MARK = "\x02"
#: Characters of the text before and after a candidate that tell what it is.
LEAD, TAIL = 80, 40
#: Words that name what they stand before as secret, and words that name it as something else.
SECRET_WORDS = "password|passwd|passphrase|pwd|token|secret|api_?key|apikey|auth|bearer|credential|private"
OTHER_WORDS = "commit|sha1|sha256|md5|checksum|digest|uuid|guid|version|example|sample|dummy|test|build|revision|hash|etag|serial|order|invoice"
FEATURES = ["length", "switches", "digit_share", "upper_share", "distinct_share", "transitions", "hex", "repeats", "dictionary", "in_path", "in_address", "extension", "assigned", "quoted", "secret_word", "other_word", "prefix_key"]
#: Most labelled findings that a forest is trained on; those of the least hashes.
TRAINED = 20_000
#: Words of the dictionary: the most frequent ones, of all that are counted.
DICTIONARY = 50_000
#: Kinds of characters that transitions are counted between: a to z, other letters, all else.
KINDS = 28


@dataclass
class Lexicon:
    """What a corpus says about words: (word) of its most frequent ones, log P(kind | kind before), its long words."""

    dictionary: DataFrame
    transitions: list[float]
    long_words: DataFrame


def _kinds(text: Column) -> Column:
    """The kind of each character, from 0."""
    return F.transform(F.filter(F.split(F.lower(text), ""), lambda x: x != ""), lambda x: F.when(x.between("a", "z"), F.ascii(x) - 97).when(x.rlike(r"\p{L}"), 26).otherwise(27))


def lexicon(docs: DataFrame, text: str = "text") -> Lexicon:
    """Counts the words (runs of letters, lower case) of all texts, and the transitions between their letters, each word as often as it
    stands there. Null and empty texts have none; without words all transitions are alike."""
    rows = renamed(docs, {"body": text})
    words = rows.select(F.explode(F.regexp_extract_all(F.lower("body"), F.lit(r"\p{L}+"), F.lit(0))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    words = table(words, "secret-words")
    kinds = words.select("n", _kinds(F.col("word")).alias("k")).where("size(k) > 1")
    pairs = kinds.select("n", F.explode(F.expr(f"transform(sequence(0, size(k) - 2), i -> k[i] * {KINDS} + k[i + 1])")).alias("pair"))
    found = dict(map(tuple, pairs.groupBy("pair").agg(F.sum("n")).collect()))  # at most KINDS * KINDS
    sums = [sum(found.get(a * KINDS + b, 0) for b in range(KINDS)) for a in range(KINDS)]
    logs = [math.log((found.get(a * KINDS + b, 0) + 1) / (sums[a] + KINDS)) for a in range(KINDS) for b in range(KINDS)]
    often = words.where("length(word) > 2 and n > 1").orderBy(F.desc("n"), "word").limit(DICTIONARY).select("word")
    return Lexicon(table(often, "secret-dictionary"), logs, words.where(r"word rlike '^[a-z]{16,64}$'").select("word"))


def _parts(text: Column) -> Column:
    """A text cut at candidates: those are the elements of odd index."""
    cut = F.split(F.regexp_replace(F.translate(text, MARK, " "), PASSWORD, f"$1{MARK}$2{MARK}"), MARK)
    return F.flatten(F.transform(cut, lambda x, i: F.when(i % 2 == 1, F.array(x)).otherwise(F.split(F.regexp_replace(x, KEY, f"{MARK}$0{MARK}"), MARK))))


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, place, lead, candidate, tail): each candidate of each text, however many stand in a word; place is its number in
    the text, from 0; lead and tail are the characters before and after, LEAD and TAIL at most, to the next candidate.

    Null and empty texts have none. Repeated rows each give theirs.
    """
    rows = renamed(docs, {"doc_id": doc_id, "body": text}).where(F.col("body").rlike(f"{KEY}|{PASSWORD}"))
    cut = rows.select("doc_id", _parts(F.col("body")).alias("p")).where("size(p) > 1")
    each = F.expr(f"transform(sequence(1, size(p) - 1, 2), i -> named_struct('place', int((i - 1) / 2), 'lead', right(p[i - 1], {LEAD}), 'candidate', p[i], 'tail', left(p[i + 1], {TAIL})))")
    return cut.select("doc_id", F.explode(each).alias("s")).select("doc_id", "s.*")


def features(found: DataFrame, lexicon: Lexicon) -> DataFrame:
    """found (lead, candidate, tail) with the columns FEATURES, doubles. Nulls count as empty. found is read twice, so it should be a table."""
    c, lead, tail = (F.coalesce(F.col(n), F.lit("")) for n in ("candidate", "lead", "tail"))
    word = F.concat(F.regexp_extract(lead, r"\S*$", 0), c, F.regexp_extract(tail, r"^\S*", 0))
    before, around = F.lower(F.right(lead, F.lit(40))), F.lower(F.concat(lead, F.lit(" "), F.left(tail, F.lit(20))))
    n = F.greatest(F.length(c), F.lit(1))
    count = lambda pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    switch = r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
    logs = F.array(*map(F.lit, lexicon.transitions))
    steps = F.transform(F.col("kinds__"), lambda k, i: F.when(i > 0, F.get(logs, F.get(F.col("kinds__"), i - 1) * KINDS + k)).otherwise(0.0))
    made: dict[str, Column] = {
        "length": F.length(c),
        "switches": count(switch) / n,
        "digit_share": count("[0-9]") / n,
        "upper_share": count("[A-Z]") / n,
        "distinct_share": F.size(F.array_distinct(F.split(c, ""))) / n,
        "transitions": F.aggregate(steps, F.lit(0.0), lambda a, x: a + x) / n,
        "hex": c.rlike("^[0-9a-f]+$"),
        "repeats": count(r"(.)(?=\1)") / n,
        "dictionary": F.col("covered__") / n,
        "in_path": word.rlike(r"/[^/]*/|^/|\\"),
        "in_address": word.rlike(r"(?i)https?:|www\.|@"),
        "extension": word.rlike(r"(?i)\.(html?|pdf|png|jpe?g|gif|txt|md|csv|zip|js|css)\b"),
        "assigned": lead.rlike(r"[=:]\s*[\"']?$"),
        "quoted": lead.rlike("[\"']$") & tail.rlike("^[\"']"),
        "secret_word": before.rlike(SECRET_WORDS),
        "other_word": around.rlike(OTHER_WORDS) | F.lower(c).rlike("example|xxxx|1234567|abcdef0"),
        "prefix_key": c.rlike("^(AKIA|ASIA|ghp_|gho_|sk_live_|xox[bp]-|AIza)"),
    }
    whole = found.withColumn("kinds__", _kinds(c)).withColumn("id__", F.monotonically_increasing_id())
    runs = whole.select("id__", F.explode(F.regexp_extract_all(c, F.lit("[A-Z]?[a-z]{2,}|[A-Z]{3,}"), F.lit(0))).alias("run")).withColumn("word", F.lower("run"))
    covered = runs.join(F.broadcast(lexicon.dictionary), "word").groupBy("id__").agg(F.sum(F.length("run")).alias("covered__"))  # DICTIONARY words at most
    joined = whole.join(covered, "id__", "left")
    return joined.select(*[f"`{x}`" for x in found.columns], *[F.coalesce(made[name].cast("double"), F.lit(0.0)).alias(name) for name in FEATURES])


def labelled_findings(spark: SparkSession, lexicon: Lexicon, n: int = 6000) -> DataFrame:
    """n labelled findings (lead, candidate, tail, label, kind), made by rule, and long words of the corpus, which are no secrets: keys of common kinds
    under common names; and what patterns take for keys: digests, identifiers, names, paths, placeholders. A
    table of findings that people have labelled can stand in its place."""
    h = lambda k: F.sha2(F.concat_ws("-", F.lit(k), F.col("id").cast("string")), 256)
    pick = lambda k, *of: F.element_at(F.array(*map(F.lit, of)), (F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(len(of))) + 1).cast("int"))
    letters = F.upper(F.translate(F.substring(h("caps"), 1, 16), "0123456789abcdef", "ABCDKLMNOPQRSTUV"))
    caps = F.when(F.pmod("id", F.lit(3)) == 0, letters).otherwise(F.upper(F.translate(F.substring(h("caps"), 1, 16), "0123456789abcdef", "A2B3C4D5E6F7GHKM")))
    mixed = F.regexp_replace(F.substring(F.base64(F.unhex(h("mixed"))), 1, 36), "=", "")
    names = ("report", "chapter", "image", "document", "version", "archive", "section", "template", "summary", "account", "meeting", "project")
    plain, rest = pick("plain", *names), pick("rest", "final", "draft", "backup", "release", "large", "source", "public", "index", "review", "copy")
    number = F.pmod(F.xxhash64(F.lit("no"), "id"), F.lit(100000)).cast("string")
    uuid = F.concat_ws("-", *[F.substring(h("uuid"), a, b) for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    filler = [pick(f"f{i}", "and the", "the of", "see also", "it was", "in this", "est une", "der und", "que la", "on it", "for") for i in range(2)]
    says = lambda *of: F.concat(filler[0], F.lit(" "), *[F.lit(x) if isinstance(x, str) else x for x in of])
    then = F.concat(F.lit(" "), filler[1])
    quote = pick("q", '"', "'")
    kinds = [
        ("aws", 1, says(pick("k", "", "key ", "id: ")), F.concat(F.lit("AKIA"), caps), then),
        ("quoted", 1, says(pick("a", "token = ", "secret = ", "api_key = ", "auth: ", "API_KEY="), quote), F.substring(h("t"), 1, 40), F.concat(quote, then)),
        ("password", 1, says(pick("pw", "password=", "pwd: ", "passwd = ")), F.concat(F.substring(h("p"), 1, 4), plain, F.substring(h("p"), 5, 10)), then),
        ("passphrase", 1, says(pick("pp", "password=", "passphrase: ")), F.concat(F.initcap(plain), F.lit("!"), rest, F.substring(h("x"), 1, 3)), then),
        ("bearer", 1, says(pick("b", "Bearer ", "token: ", "secret: ", "auth key = ")), mixed, then),
        ("prefixed", 1, says(""), F.concat(pick("pre", "ghp_", "sk_live_", "gho_"), F.substring(h("g"), 1, 36)), then),
        ("joined", 1, says("id=", number, pick("j", "&token=", ";api_key=", ",\"secret\":\"")), F.substring(h("j"), 1, 32), F.lit(";x=1")),
        ("block", 1, says("PRIVATE KEY-----\n"), F.base64(F.unhex(F.concat(h("b1"), F.substring(h("b2"), 1, 32)))), F.lit("\n")),
        ("commit", 0, says(pick("c", "commit ", "revision ", "sha1 ", "checksum ")), F.substring(h("s"), 1, 40), then),
        ("digest", 0, says(pick("d", "md5 ", "etag: ", "digest ", "hash=")), F.substring(h("m"), 1, 32), then),
        ("uuid", 0, says(pick("e", "uuid ", "id=", "session ", "request ")), uuid, then),
        ("number", 0, says(pick("g", "card ", "and ", "token ", "number ", "no. ")), F.substring(F.translate(h("n"), "abcdef", "012345"), 1, 16), then),
        ("name", 0, says(""), F.concat_ws("_", plain, rest, number), then),
        ("address", 0, says("http://example.org/files/"), F.concat_ws("-", plain, rest, number, F.lit("copy")), F.concat(F.lit(".html"), then)),
        ("path", 0, says("see "), F.concat(F.lit("/usr/local/share/"), plain, F.lit("/"), rest), F.concat(F.lit(".txt"), then)),
        ("rule", 0, says(""), F.repeat(pick("r", "-", "_", "=-", "-+"), 20), then),
    ]
    made = F.array(*[F.struct(lead.alias("lead"), c.alias("candidate"), tail.alias("tail"), F.lit(label).alias("label"), F.lit(kind).alias("kind")) for kind, label, lead, c, tail in kinds])
    ruled = spark.range(n).select(F.element_at(made, (F.pmod("id", F.lit(len(kinds))) + 1).cast("int")).alias("r")).select("r.*")
    words = lexicon.long_words.orderBy(F.xxhash64("word"), "word").limit(n // len(kinds) * 3)
    case = F.pmod(F.xxhash64("word", F.lit("case")), F.lit(3))
    written = F.when(case == 0, F.col("word")).when(case == 1, F.initcap("word")).otherwise(F.upper("word"))
    return ruled.unionByName(words.select(F.lit("and the ").alias("lead"), written.alias("candidate"), F.lit(" of").alias("tail"), F.lit(0).alias("label"), F.lit("word").alias("kind")))


def train(findings: DataFrame, lexicon: Lexicon, trees: int = 20, depth: int = 8, seed: int = 7) -> PipelineModel:
    """A forest from labelled findings (lead, candidate, tail, label 0 or 1), of at most TRAINED of them."""
    few = findings.where("label is not null and candidate is not null").select("lead", "candidate", "tail", "label").orderBy(F.xxhash64("candidate", "lead", "tail"), "candidate", "label").limit(TRAINED)
    rows = features(table(few, "secret-findings"), lexicon).withColumn("label", F.col("label").cast("double"))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.8)
    return PipelineModel([assembler, forest.fit(table(assembler.transform(rows).orderBy("candidate", "lead", "label"), "secret-training"))])


def scan(docs: DataFrame, forest: PipelineModel, lexicon: Lexicon, threshold: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, place, lead, candidate, tail, score, secret) of each candidate: the forest's probability that it is a
    secret, and whether that is at least the threshold; others are false positives."""
    scored = forest.transform(features(table(candidates(docs, doc_id, text), "secret-candidates"), lexicon))
    score = vector_to_array("probability")[1]
    return scored.select("doc_id", "place", "lead", "candidate", "tail", score.alias("score"), (score >= threshold).alias("secret"))


def redact(docs: DataFrame, forest: PipelineModel, lexicon: Lexicon, threshold: float = 0.5, put: str = "[SECRET]", text: str = "text") -> DataFrame:
    """docs, all rows and columns, with `put` in the place of each secret. Rows are told apart by number; texts without a secret stay as they are."""
    rows = table(docs.withColumn("secret__row", F.monotonically_increasing_id()), "secret-rows")
    found = scan(rows, forest, lexicon, threshold, "secret__row", text).where("secret")
    places = found.groupBy(F.col("doc_id").alias("secret__row")).agg(F.collect_set(F.col("place") * 2 + 1).alias("secret__at"))
    clean = F.array_join(F.transform(_parts(F.col(f"`{text}`")), lambda x, i: F.when(F.array_contains("secret__at", i), F.lit(put)).otherwise(x)), "")
    joined = rows.join(places, "secret__row", "left")
    return joined.select(*[F.when(F.col("secret__at").isNull(), F.col(f"`{c}`")).otherwise(clean).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
