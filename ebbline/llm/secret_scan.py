"""Secret scan: candidates by pattern, false positives removed by a random forest.

Candidates are values in runs of at least ``SHORTEST`` ASCII letters, digits and ``_+/=-`` (letters of other scripts end a run), and
four kinds of whole values that runs can't hold: JSON web tokens with their dots, PEM private keys with their lines, passwords in
URLs, and shorter quoted values of ``SHORTEST_ASSIGNED`` characters or more that are assigned to a credential's name. A run is
cut after its first ``=`` into name and value, and at each ``/`` if it is in the path of a URL or holds a known shape between them; the
parts of ``SHORTEST`` characters and those of a known shape are the candidates, or the whole run if there is none. The forest sees a
candidate's length, its character transitions (changes between digits and others, between cases, between vowels and consonants),
how much of it is made of dictionary words, the path it was found under, and the words around it. Dictionary words are those that a
share ``WORD_SHARE`` of the different texts of the whole corpus have, and ``MIN_DOCS`` at least, outside of runs that hold candidates.

The forest learns from labelled findings: a table ``(doc_id, start, label)`` of reviewed ones, or else ``examples`` of a dozen kinds of
secrets and as many look-alikes (commit ids, checksums, UUIDs, identifiers, encoded images, slugs), together with the corpus's own clear
cases: hexadecimal digits assigned to a credential's name are a secret, a candidate with neither a shape nor such a name is
none. Learning reads about ``TRAIN_ROWS`` findings of each label, drawn by a hash (a documented bound). A value of a known
shape (``KNOWN``: prefixes that providers give to their keys, web tokens, private keys) is always kept unless reviewed as none.

Built of DataFrame functions and MLlib only. Coverage is worked out once for each different value, so copies of a value that
holds much of the rows are summed before anything is joined; the join back to the findings is one that AQE can split. Words are
counted where the texts lie: only digests are shuffled, and the words of texts that have copies.

Defined results: text NULL or empty has no candidates; a missing path or neighbour is the empty word; repeated rows are reported
each; with reviewed findings of one label only nothing can be learned, and every finding scores 1 if all labels are secrets, else known
shapes that aren't reviewed as none score 1 and the rest 0; ``start`` is where the value begins, not its name; very long texts are
searched whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm.common import stored
from ebbline.operators.membership import is_small

SHORTEST = 16
SHORTEST_ASSIGNED = 8
MIN_DOCS = 3
WORD_SHARE = 1e-4
TRAIN_ROWS = 10_000
TREES, DEPTH, SEED = 60, 10, 2
EXAMPLES = 200  # of each kind
THRESHOLD = 0.5
HASHED = 64

_RUN = "A-Za-z0-9_+/=-"
_OTHER = r"\p{L}\p{N}_+/=-"
CANDIDATE = rf"(?<![{_OTHER}])[{_RUN}]{{{SHORTEST},}}+(?![{_OTHER}])"
RUN = rf"(?<![{_RUN}])[{_RUN}]{{{SHORTEST},}}+"  # whatever other letters it touches
# Names that credentials are assigned to, and shapes of well-known credentials.
_NAMED = r"(?i)(?:token|secret|passw(?:or)?d|passwd|api[_-]?key|access[_-]?key|auth|credential)s?"
ASSIGNED = _NAMED + r"[\"']?\s*(?:=|:=?|=>)\s*[\"']?$"
# How keys of well-known providers begin, web tokens, private keys.
_JWT = r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"
_PEM = r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----[^-]*+(?:-(?!----)[^-]*+)*+-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----"
_PREFIXED = (
    r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{30,}|glpat-[A-Za-z0-9_-]{20,}|sk[-_][A-Za-z0-9_-]{20,}|"
    r"xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|npm_[A-Za-z0-9]{36}|hf_[A-Za-z0-9]{30,}"
)
KNOWN = rf"^(?:{_PREFIXED}|{_JWT}|{_PEM})$"
SHAPE = rf"^(?:[0-9a-fA-F]{{32,64}}|{_PREFIXED}|eyJ[A-Za-z0-9_-]{{10,}}|{_JWT}|{_PEM})$"
# The first look behind is of one character, so that the longer one is seldom tried.
_IN_URL = r"(?<=:)(?<=://[^\s/@:]{0,64}:)[^\s/@:]{4,}+(?=@)"
_QUOTED = (
    rf"(?<=[\"'])(?<=(?i:token|secret|password|passwd|passwrd|api_key|api-key|apikey|credential)s?[\"']?\s{{0,3}}(?:=|:|=>)\s{{0,3}}[\"'])"
    rf"[^\s\"']{{{SHORTEST_ASSIGNED},{SHORTEST - 1}}}(?=[\"'])"
)
_WHOLE = rf"{_PEM}|(?<![.{_RUN}]){_JWT}(?![{_RUN}])|{_IN_URL}|{_QUOTED}"
EVERY = rf"{_WHOLE}|{RUN}"  # what the scan looks for
_NAME_PART = "^[^=]*+=++(?!$)"
_URL_GOES_ON = r"^[^\s?#\"'<>,;|]*$"
_URL_PATH = r"://[^\s?#\"'<>,;|]*$"
_DIGIT_CHANGE = "(?<=[0-9])(?=[^0-9])|(?<=[^0-9])(?=[0-9])"
_CASE_CHANGE = "(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"
_VOWEL_CHANGE = "(?<=[aeiouAEIOU])(?=[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z])|(?<=[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z])(?=[aeiouAEIOU])"
NUMERIC = ("n_chars", "digits", "uppers", "signs", "different", "digit_changes", "case_changes", "vowel_changes", "coverage", "path_depth", "assigned")
WORDS = ("path", "word_before", "second_before", "word_after")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source", pattern: str = CANDIDATE) -> DataFrame:
    """``(doc_id, path, start, value, before, after, in_url)``: every run that stands alone, or that ``pattern`` finds, with its place, the text
    around it, and whether it stands in a URL, however long."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    path = F.coalesce(F.col(path_col).cast("string"), F.lit(""))
    held = docs.select(F.col(id_col).cast("long").alias("doc_id"), path.alias("path"), text.alias("text")).filter(F.col("text").rlike(pattern))
    found = held.select("doc_id", "path", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("values"), F.split("text", pattern, -1).alias("gaps"))
    # Only the ends of the gaps go along, so a long text isn't repeated for each of its candidates.
    sized = found.select(
        "doc_id", "path", "values",
        F.transform(
            "gaps",
            lambda g: F.struct(F.length(g).alias("n"), F.right(g, F.lit(80)).alias("end"), F.left(g, F.lit(40)).alias("begin"), g.rlike(_URL_PATH).alias("url"), g.rlike(_URL_GOES_ON).alias("on")),
        ).alias("gaps"),
    )
    # A URL may reach over several candidates, with nothing between them that would end it.
    in_urls = F.aggregate(
        "gaps", F.array().cast("array<boolean>"),
        lambda known, g: F.concat(known, F.array(g["url"] | (g["on"] & F.coalesce(F.try_element_at(known, F.lit(-1)), F.lit(False))))),
    )
    sized = sized.withColumn("in_urls", in_urls)
    one = F.explode(
        F.transform(
            "values",
            lambda v, k: F.struct(
                v.alias("value"),
                F.get("gaps", k)["end"].alias("before"),
                F.get("gaps", k + 1)["begin"].alias("after"),
                F.get("in_urls", k).alias("in_url"),
                (
                    F.aggregate(F.slice("gaps", F.lit(1), k + 1), F.lit(0).cast("long"), lambda s, g: s + g["n"])
                    + F.aggregate(F.slice("values", F.lit(1), k), F.lit(0).cast("long"), lambda s, w: s + F.length(w))
                ).alias("start"),
            ),
        )
    )
    return sized.select("doc_id", "path", one.alias("one")).select("doc_id", "path", "one.start", "one.value", "one.before", "one.after", "one.in_url")


def parted(runs: DataFrame) -> DataFrame:
    """The same columns for the values in the runs, each with its own place and the text around it."""
    name = F.length(F.regexp_extract("value", _NAME_PART, 0))
    # A run after "://" has the rest of the URL so far before it; "//host" has only the colon.
    in_path = F.concat("before", F.left("value", F.lit(2))).rlike("://$") | F.col("in_url")
    alone = F.col("value").rlike(f"^(?:{_JWT}|{_PEM})$") | (F.length("value") < SHORTEST) | (F.col("before").rlike(r"://[^\s/@:]{0,64}:$") & F.startswith("after", F.lit("@")))
    cut = runs.withColumn("_name", F.when(alone, 0).otherwise(name)).withColumn("_in_path", in_path & ~alone).withColumn("_alone", alone)

    def at_slashes(part: Column) -> Column:
        pieces = F.split(part, "(?<=/)", -1)  # each with its own slash, so that lengths add up to places
        known = F.exists(pieces, lambda p: F.rtrim(p, F.lit("/")).rlike(SHAPE))
        return F.when(~F.col("_alone") & F.contains(part, F.lit("/")) & (F.col("_in_path") | known), pieces).otherwise(F.array(part))

    pieces = F.concat(at_slashes(F.left("value", F.col("_name"))), at_slashes(F.expr("substring(value, _name + 1)")))
    cut = cut.withColumn("_pieces", pieces)
    placed = F.transform(
        "_pieces",
        lambda p, k: F.struct(
            F.aggregate(F.slice("_pieces", F.lit(1), k), F.lit(0), lambda n, q: n + F.length(q)).alias("at"),
            F.when((F.size("_pieces") > 1) & (k < F.size("_pieces") - 1), F.regexp_replace(p, "(?:/|=+)$", "")).otherwise(p).alias("part"),
        ),
    )
    own = F.filter(placed, lambda p: (F.length(p["part"]) >= SHORTEST) | p["part"].rlike(SHAPE))
    whole = F.array(F.struct(F.lit(0).alias("at"), F.col("value").alias("part")))
    one = cut.withColumn("_one", F.explode(F.when(F.size(own) > 0, own).otherwise(whole)))
    at, part = F.col("_one.at"), F.col("_one.part")
    return one.select(
        "doc_id", "path", (F.col("start") + at).alias("start"), part.alias("value"),
        F.right(F.concat("before", F.left("value", at)), F.lit(80)).alias("before"),
        F.left(F.concat(F.substring("value", at + F.length(part) + 1, F.length("value")), "after"), F.lit(40)).alias("after"),
    )


def dictionary(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS, share: float = WORD_SHARE) -> DataFrame:
    """``(word)``: lower-case ASCII words of three letters or more that so many different texts, and such a share of them, have outside of runs."""
    text = F.col(text_col).cast("string")
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.regexp_replace(F.col("text"), RUN, " ")), F.lit(r"(?<!\p{L})[a-z]{3,}+(?!\p{L})"), F.lit(0)))
    texts = docs.filter(text.isNotNull()).select(text.alias("text")).withColumn("digest", F.md5(F.col("text").cast("binary")))
    copied = stored(texts.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest", F.lit(True).alias("copied")), "copied-texts")
    marked = texts.join(F.broadcast(copied) if is_small(copied) else copied, "digest", "left")
    single = marked.filter("copied is null").select(words.alias("words"))
    once = marked.filter("copied").select("digest", words.alias("words")).dropDuplicates(["digest"]).select("words")
    texts = single.unionByName(once)
    # The empty word stands in every text, so its count is the number of texts.
    counted = texts.select(F.explode(F.concat("words", F.array(F.lit("")))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    counted = stored(counted, "word-counts")
    every = counted.filter("word = ''").first()
    return counted.filter((F.col("n") >= max(min_docs, share * (every["n"] if every else 0))) & (F.col("word") != "")).select("word")


def _share(value: Column, kind: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{kind}]", "")) / F.length(value)


def _word(text: Column, pattern: str) -> Column:
    return F.lower(F.regexp_extract(text, pattern, 1))


def describe(found: DataFrame, words: DataFrame) -> DataFrame:
    """Add the forest's columns to candidates."""
    value = F.col("value")
    values = found.select("value").distinct()
    pieces = values.select("value", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    covered = pieces.join(words, "word").groupBy("value").agg(F.sum(F.length("word")).alias("covered"))
    n = F.length("value")
    shape = values.join(covered, "value", "left").select(
        "value",
        n.cast("double").alias("n_chars"),
        _share(value, "0-9").alias("digits"),
        _share(value, "A-Z").alias("uppers"),
        _share(value, "_+/=-").alias("signs"),
        (F.size(F.array_distinct(F.split("value", ""))) / n).alias("different"),
        (F.regexp_count("value", F.lit(_DIGIT_CHANGE)) / n).alias("digit_changes"),
        (F.regexp_count("value", F.lit(_CASE_CHANGE)) / n).alias("case_changes"),
        (F.regexp_count("value", F.lit(_VOWEL_CHANGE)) / n).alias("vowel_changes"),
        (F.coalesce("covered", F.lit(0)) / n).alias("coverage"),
    )
    around = found.select(
        "doc_id", "path", "start", "value",
        (F.size(F.split("path", "/")) - 1).cast("double").alias("path_depth"),
        (F.col("before").rlike(ASSIGNED) | F.col("value").rlike(_NAMED + "=")).cast("double").alias("assigned"),
        _word(F.col("before"), r"([\p{L}\p{N}_]+)[^\p{L}\p{N}_]*$").alias("word_before"),
        _word(F.col("before"), r"([\p{L}\p{N}_]+)[^\p{L}\p{N}_]+[\p{L}\p{N}_]+[^\p{L}\p{N}_]*$").alias("second_before"),
        _word(F.col("after"), r"^[^\p{L}\p{N}_]*([\p{L}\p{N}_]+)").alias("word_after"),
    )
    # Stored, so that the join reads tables on both sides: then AQE can broadcast the values or split one with many findings.
    return around.join(stored(shape, "finding-values"), "value")


def clear_cases(rows: DataFrame) -> DataFrame:
    """Add ``label`` by rule: 1 or 0 for the clear cases, NULL for the rest."""
    shaped, assigned = F.col("value").rlike(SHAPE), F.col("assigned") > 0
    return rows.withColumn("label", F.when(shaped & assigned, 1.0).when(~shaped & ~assigned, 0.0))


def examples(spark: SparkSession, n: int = EXAMPLES, seed: int = SEED) -> DataFrame:
    """``(doc_id, text, source, label)``: short texts, ``n`` of each kind, that hold one secret (1) or one look-alike (0) each.

    Values are drawn by hashes of kind, number and seed, so they are the same in every run.
    """
    at = spark.range(0, n, 1, 1).withColumnRenamed("id", "i")

    def raw(name: str) -> Column:
        return F.sha2(F.concat_ws("|", F.lit(f"{seed}-{name}"), F.col("i").cast("string")).cast("binary"), 256)

    def code(name: str, size: int) -> Column:
        """Letters of both cases and digits."""
        both = F.concat(F.base64(F.unhex(raw(name))), F.base64(F.unhex(raw(name + "+"))))
        return F.left(F.regexp_replace(both, "[+/=\\s]", "x"), F.lit(size))

    def one_of(name: str, *choices: str) -> Column:
        place = F.pmod(F.xxhash64(F.lit(f"{seed}-{name}-of"), "i"), F.lit(len(choices))).cast("int")
        return F.get(F.array(*[F.lit(c) for c in choices]), place)

    def said(before: Column | str, value: Column, after: Column | str = "") -> Column:
        filler = one_of("filler", "we saw that ", "in the notes of the day ", "und dann stand dort ", "", "la page dit que ", "el texto dice ")
        rest = one_of("rest", " and it went on.", "", " for all of them", "\nand more lines", " und weiter")
        return F.concat(filler, F.lit(before) if isinstance(before, str) else before, value, F.lit(after) if isinstance(after, str) else after, rest)

    def hexa(name: str, size: int) -> Column:
        return F.left(raw(name), F.lit(size))

    name = one_of("name", "token", "secret", "api_key", "access_key", "auth_token", "client_secret", "apikey")
    opening = one_of("opening", " = \"", ": \"", "=", ": ", " := '", "=\"")
    words = ("stein", "under", "light", "garden", "water", "north", "table", "record", "value", "index", "maison", "libro", "strasse", "handler", "buffer")

    def joined(name: str, sign: str, capital: bool = False) -> Column:
        parts = [one_of(f"{name}{k}", *words) for k in range(4)]
        return F.concat_ws(sign, *[F.initcap(p) if capital else p for p in parts])

    b64 = lambda name: F.regexp_replace(F.base64(F.unhex(F.concat(raw(name), raw(name + "-")))), "[=\\s]", "")
    url_safe = lambda name, size: F.left(F.translate(b64(name), "+/", "-_"), F.lit(size))
    kinds = {
        1: [
            said(F.concat(name, opening), hexa("h40", 40)), said(F.concat(name, opening), hexa("h32", 32)), said(F.concat(name, opening), hexa("h64", 64)),
            said(F.concat(name, opening), F.left(b64("b64"), F.lit(40))), said(F.concat(F.lit("password"), opening), code("pw", 24)),
            said(F.concat(F.lit("passwd"), F.lit(" = \"")), code("short", 12), "\""), said("the key ", F.concat(F.lit("AKIA"), F.upper(hexa("akia", 16)))),
            said("use ", F.concat(F.lit("ghp_"), code("gh", 36))), said("STRIPE=", F.concat(F.lit("sk_live_"), code("sk", 24))),
            said("slack ", F.concat(F.lit("xoxb-"), hexa("xo", 12), F.lit("-"), code("xox", 24))),
            said("Bearer ", F.concat(F.lit("eyJ"), url_safe("j1", 30), F.lit(".eyJ"), url_safe("j2", 60), F.lit("."), url_safe("j3", 43))),
            said("", F.concat(F.lit("-----BEGIN RSA PRIVATE KEY-----\n"), F.left(b64("p1"), F.lit(64)), F.lit("\n"), F.left(b64("p2"), F.lit(64)), F.lit("\n-----END RSA PRIVATE KEY-----"))),
            said("postgres://admin:", code("url", 18), "@db.example.net:5432/app"), said(F.concat(F.lit("aws_secret_access_key"), opening), F.left(b64("aws"), F.lit(40))),
        ],
        0: [
            said(one_of("vcs", "commit ", "revision ", "merged ", "parent ", "tree "), hexa("c40", 40)),
            said(one_of("sum", "sha256: ", "checksum ", "md5sum ", "digest: ", "etag: "), hexa("c64", 64)), said(one_of("md5", "md5 ", "hash: ", "fingerprint "), hexa("c32", 32)),
            said(one_of("uid", "id ", "uuid: ", "request "), F.concat_ws("-", hexa("u1", 8), hexa("u2", 4), hexa("u3", 4), hexa("u4", 4), hexa("u5", 12))),
            said("call ", joined("snake", "_"), "()"), said("the class ", joined("camel", "", True)), said("see https://example.org/", joined("slug", "-")),
            said("data:image/png;base64,", F.concat(F.lit("iVBORw0KGgo"), b64("img"))), said("open ", F.concat(F.lit("/usr/share/"), joined("file", "/"))),
            said("number ", F.translate(hexa("digits", 20), "abcdef", "123456")), said("", F.repeat(one_of("rule", "=", "-", "_"), F.lit(24))),
            said(F.concat(name, F.lit(" = \"")), one_of("hold", "your_token_goes_here", "xxxxxxxxxxxxxxxxxxxx", "changeme_changeme", "example_secret_value", "insert-your-key-here"), "\""),
            said(F.concat(name, F.lit(": ")), joined("setting", "_")), said("chapter ", joined("title", "-", True)),
        ],
    }
    rows = [at.select(F.col("i"), F.lit(k).alias("kind"), c.alias("text"), F.lit(float(label)).alias("label")) for label, found in kinds.items() for k, c in enumerate(found)]
    every = reduce(DataFrame.unionByName, rows).coalesce(4)
    number = (F.col("i") * 64 + F.col("kind") * 2 + F.col("label").cast("long")).alias("doc_id")
    return every.select(number, "text", F.lit("").alias("source"), "label")


def _drawn(rows: DataFrame, label: float, n: int, bound: int) -> DataFrame:
    own = rows.filter(F.col("label") == label)
    if n <= bound:
        return own
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", "start", "value"), 11).cast("double") / F.lit(float(1 << 53))
    return own.filter(draw < bound / n)


def _vectors(rows: DataFrame) -> DataFrame:
    hasher = FeatureHasher(inputCols=list(WORDS), outputCol="_words", numFeatures=HASHED, categoricalCols=list(WORDS))
    return VectorAssembler(inputCols=[*NUMERIC, "_words"], outputCol="_features").transform(hasher.transform(rows))


def scan(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source",
         train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``(doc_id, path, start, value, score)`` of every candidate; ``score`` is the forest's chance that it is a secret."""
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(path_col).alias("source"), F.col(text_col).cast("string").alias("text"))
    words = dictionary(text)
    rows = describe(stored(parted(candidates(text, pattern=EVERY)), "candidates"), words)
    known = F.col("value").rlike(KNOWN)
    if labels is None:
        rows = stored(clear_cases(rows), "findings")
    else:
        reviewed = labels.select("doc_id", "start", F.col("label").cast("double").alias("label")).dropDuplicates(["doc_id", "start"])
        rows = stored(rows.join(reviewed, ["doc_id", "start"], "left"), "findings")
    counts = {r["label"]: r["n"] for r in rows.filter("label in (0, 1)").groupBy("label").agg(F.count("*").alias("n")).collect()}
    if labels is not None and len(counts) < 2:
        rest = F.lit(1.0 if counts.get(1.0) else 0.0)
        score = F.when(F.col("label") == 0, 0.0).when(F.col("value").rlike(SHAPE), 1.0).otherwise(rest)
        return rows.select("doc_id", "path", "start", "value", score.alias("score"))
    sample = _drawn(rows, 1.0, counts.get(1.0, 0), train_rows).unionByName(_drawn(rows, 0.0, counts.get(0.0, 0), train_rows))
    if labels is None:
        shown = stored(examples(docs.sparkSession), "examples")
        taught = describe(stored(parted(candidates(shown, pattern=EVERY)), "example-candidates"), words)
        # A text's paths and places say nothing here; the paths are those of the corpus for what it shows itself.
        sample = sample.unionByName(taught.join(shown.select("doc_id", "label"), "doc_id"))
    # In an order of its own, so the forest's draws don't depend on how the rows were dealt out.
    ordered = sample.repartition(8, F.xxhash64("value", "doc_id", "start")).sortWithinPartitions("value", "doc_id", "start")
    forest = RandomForestClassifier(featuresCol="_features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    model = forest.fit(_vectors(ordered).select("_features", "label"))
    scored = model.transform(_vectors(rows)).withColumn("_chance", F.get(vector_to_array("probability"), F.lit(1)))
    reviewed_none = F.coalesce(F.col("label") == 0, F.lit(False)) if labels is not None else F.lit(False)
    score = F.when(known & ~reviewed_none, 1.0).otherwise(F.col("_chance"))
    return scored.select("doc_id", "path", "start", "value", score.alias("score"))


def secrets(docs: DataFrame, labels: DataFrame | None = None, threshold: float = THRESHOLD, **options) -> DataFrame:
    """``(doc_id, path, start, n_chars, preview, value_sha256, score)`` of the findings that are kept; values are not shown."""
    kept = scan(docs, labels, **options).filter(F.col("score") >= threshold)
    return kept.select(
        "doc_id", "path", "start", F.length("value").alias("n_chars"), F.concat(F.left("value", F.lit(4)), F.lit("...")).alias("preview"),
        F.sha2("value", 256).alias("value_sha256"), F.round("score", 6).alias("score"),
    )
