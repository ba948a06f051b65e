"""Secret scan: candidate strings, random forest against false positives, redaction.

Only DataFrame functions and Spark's own random forest are used.  A candidate is
a run of at least ``MIN_LENGTH`` key-like characters, or a value of any length and
characters that follows a keyword and "=" or ":" in its word or the two words
before, or the password of a URL.  A word with several of them (NAME=secret, a
URL, compact JSON) has a candidate for each.  The forest sees its length, character
transitions, how much of it is made of words of the corpus (the dictionary, counted
over all documents), its path and its neighbouring words, and is trained from labelled
findings.  Candidates that it scores at ``THRESHOLD`` or more are secrets.
"""

from __future__ import annotations

import functools

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runway.sources.sinks import materialise

MIN_LENGTH = 16
THRESHOLD = 0.5
DICTIONARY_MIN = 3      # a letter run is a dictionary word from this many occurrences in the corpus on
MASK = "<SECRET>"

# the "=" of NAME=value is no padding
_RUN = "[A-Za-z0-9+/_-]{16,}(?:={1,2}+(?=[\"'`]?(?:[^A-Za-z0-9\"'`]|$)))?"
# the text before a run, the run, and whether a separator makes it the name of what follows
_PARTS = f"(?s)\\G(.*?)({_RUN})(?=([\"'`\\]]{{0,3}}[=:]|))"
_CANDIDATE = f"[A-Za-z0-9+/_-]{{{MIN_LENGTH},}}"
_SPACE = r"[\x20\x09-\x0D]+"
_KEYWORDS = "(?i)(token|secret|passw|pwd|api.?key|access.?key|auth|bearer|credential|private)"
# a value: up to the closing quote, or without quotes up to the next name or the punctuation at the end
_VALUE = (r"""((?<=")[^"]+?(?=\\?(?:"|$))|(?<=')[^']+?(?=\\?(?:'|$))|(?<=`)[^`]+?(?=`|$)"""
          r"""|(?<!["'`])(?:(?![&,;][\w.-]*=)(?![,;.)\]}>\\]{0,8}(?:$|["'`]))[^"'`])++)""")
_ASSIGNS = _KEYWORDS + "[^=:]*[=:]"
# from a keyword on, the rest of the name, however long; the next keyword starts anew, so a word is read once
_KEYWORD = _KEYWORDS.replace("(?i)(", "(?i:")
_IN_WORD = f"(?s)({_KEYWORD}(?:(?!{_KEYWORD})" + r"""[\w.\-\[\]"'`\\])*+[=:]{1,2}>?\\?["'`]?)""" + _VALUE
_WHOLE = r"""(?s)^([=:(\[{<]*>?\\?["'`]?)""" + _VALUE
_URL = r"""(?s)(://[^\s:/@]*:)(?!\d{1,5}/)(\S+?)(?=@[\w.\[\]:-]+(?:[/?#,;"'`)\]}>\\]|$))"""
_URL_TEXT = r"://[^\s:/@]*:[^\s@]+@"
_BENIGN = "(?i)(sha[0-9]*|md5|commit|checksum|digest|hash|uuid|revision|build|etag|order|card|phone|ref|integrity|base64|image)"
_PLACEHOLDER = "(?i)(example|xxxx|dummy|change.?me|your|sample|placeholder|1234567|0000000|abcdef)"
_TEST_PATH = "(?i)(test|fixture|example|mock|docs?/)"
_CONFIG_PATH = r"(?i)(\.env|config|\.ya?ml|\.json|\.properties|credential|settings)"

FEATURES = ["length", "digit_share", "upper_share", "letter_share", "vowel_share", "transitions", "case_changes",
            "distinct_share", "hexadecimal", "numeric", "separators", "longest_letters", "coverage", "test_path",
            "config_path", "keyword_near", "keyword_lead", "assigned", "quoted", "benign_near", "placeholder", "named", "punctuation", "url_password"]


def candidates(docs: DataFrame, text_col: str = "text", path_col: str | None = "source", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per candidate: the carried columns, path, position (word number from 0), word, before2, before1, after, run, lead, named.

    Words are runs without ASCII white space.  NULL and empty texts have none, repeated
    rows have theirs each, no rows give no rows.
    ``run`` is the candidate itself, ``lead`` what stands before it in its word, back to
    the second run before it, ``named`` whether a separator follows.  Columns that are not carried are
    ignored, whatever their names; a carried column that is called like a result raises a ValueError.
    """
    clash = {"path", "position", "word", "before2", "before1", "after", "run", "lead", "named"} & set(carry)
    if clash:
        raise ValueError(f"carried columns are called like results: {sorted(clash)}")
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    text = F.col(text_col)
    keyed, url = text.rlike(_KEYWORDS) & text.rlike("[=:]"), text.rlike(_URL_TEXT)
    words = docs.where(text.rlike(_CANDIDATE) | keyed | url).select(
        *carry, path.alias("__path"), keyed.alias("__keyed"), url.alias("__url"),
        F.split(F.regexp_replace(text, f"^{_SPACE}", ""), _SPACE).alias("__w"))
    # words that can hold a candidate; _expand has the last word
    holds = lambda w, i: w.rlike(_CANDIDATE) | (F.col("__url") & w.rlike(_URL_TEXT)) | (F.col("__keyed") & F.concat_ws(
        " ", F.get("__w", i - 2), F.get("__w", i - 1), w).rlike(_KEYWORDS))
    found = words.select(*carry, "__path", "__w", F.explode(F.filter(
        F.transform("__w", lambda w, i: F.when(holds(w, i), i)), lambda i: i.isNotNull())).alias("position"))
    at = lambda d: F.get("__w", F.col("position") + d)
    return _expand(found.select(*carry, F.col("__path").alias("path"), "position", at(0).alias("word"),
                                at(-2).alias("before2"), at(-1).alias("before1"), at(1).alias("after"))).drop("nth")


def _expand(words: DataFrame) -> DataFrame:
    """Words -> one row per candidate of each, with ``nth`` (from 0), ``run``, ``lead`` and ``named``."""
    part = lambda k: F.regexp_extract_all("word", F.lit(_PARTS), F.lit(k))
    d = words.withColumns({"__gaps": part(1), "__runs": part(2), "__tails": part(3)})
    before = lambda a, i: F.coalesce(F.get(a, i - 1), F.lit(""))
    runs = F.transform("__runs", lambda r, i: F.struct(
        r.alias("run"), F.concat(before("__gaps", i), before("__runs", i), F.get("__gaps", i)).alias("lead"),
        (F.get("__tails", i) != "").alias("named")))
    value = lambda run, lead: F.struct(run.alias("run"), lead.alias("lead"), F.lit(False).alias("named"))
    every = lambda pattern: F.zip_with(F.regexp_extract_all("word", F.lit(pattern), F.lit(2)),
                                       F.regexp_extract_all("word", F.lit(pattern), F.lit(1)), value)
    near = F.concat_ws(" ", "before2", "before1")
    whole = F.when(near.rlike(_ASSIGNS) | (near.rlike(_KEYWORDS) & F.col("word").rlike("^[=:]")),
                   F.array(value(F.regexp_extract("word", _WHOLE, 2), F.regexp_extract("word", _WHOLE, 1))))
    d = d.withColumn("__values", F.concat(F.coalesce(whole, F.slice(every(_URL), 1, 0)), every(_IN_WORD), every(_URL)))
    # each value once, and not if it is a run of the word
    values = F.filter("__values", lambda v, i: v["run"].rlike("[A-Za-z0-9]|[^\\x00-\\x7F]") & ~F.array_contains(
        F.col("__runs"), v["run"]) & (F.array_position(F.col("__values.run"), v["run"]) == i + 1))
    return (d.select(*words.columns, F.posexplode(F.concat(runs, values)).alias("nth", "__c"))
            .select(*words.columns, "nth", "__c.*"))


def _pieces(run: str) -> F.Column:
    return F.filter(F.split(F.lower(run), "[^a-z]+"), lambda p: F.length(p) >= 3)


def dictionary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(piece): letter runs of at least 3 letters that occur at least DICTIONARY_MIN times in all texts."""
    words = docs.select(F.explode(F.split(F.lower(F.col(text_col)), "[^a-z]+")).alias("piece"))
    return (words.where(F.length("piece") >= 3).groupBy("piece").agg(F.count("*").alias("n"))
            .where(F.col("n") >= DICTIONARY_MIN).select("piece"))


def describe(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` (candidate columns) with the columns of FEATURES; ``words`` is the dictionary."""
    d = found
    # dictionary coverage of each distinct run: letters in pieces that are dictionary words
    pieces = d.select("run").distinct().select("run", F.explode(_pieces("run")).alias("piece"))
    covered = (pieces.join(words, "piece").groupBy("run").agg(F.sum(F.length("piece")).alias("__covered")))
    d = d.join(covered, "run", "left")
    size = F.greatest(F.length("run"), F.lit(1))
    share = lambda pattern: F.regexp_count("run", F.lit(pattern)) / size
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    near = F.concat_ws(" ", "before2", "before1", "lead")
    letters = F.regexp_count("run", F.lit("[A-Za-z]"))
    return d.withColumns({
        "length": F.length("run").cast("double"),
        "digit_share": share("[0-9]"), "upper_share": share("[A-Z]"), "letter_share": letters / size,
        "vowel_share": F.regexp_count("run", F.lit("(?i)[aeiou]")) / F.greatest(letters, F.lit(1)),
        "transitions": (F.regexp_count("run", F.lit("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"))) / size,
        "case_changes": F.regexp_count("run", F.lit("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])")) / size,
        "distinct_share": F.size(F.array_distinct(F.split("run", ""))) / size,
        "hexadecimal": flag(F.col("run").rlike("^([0-9a-f]+|[0-9A-F]+)$")), "numeric": flag(F.col("run").rlike("^[0-9-]+$")),
        "separators": share("[-_/+]"),
        "longest_letters": F.coalesce(F.array_max(F.transform(F.split("run", "[^A-Za-z]+"), F.length)), F.lit(0)).cast("double"),
        "coverage": F.coalesce("__covered", F.lit(0)) / size,
        "test_path": flag(F.col("path").rlike(_TEST_PATH)), "config_path": flag(F.col("path").rlike(_CONFIG_PATH)),
        "keyword_near": flag(near.rlike(_KEYWORDS)), "keyword_lead": flag(F.col("lead").rlike(_KEYWORDS)),
        "assigned": flag(F.col("before1").rlike("[=:]>?$") | F.col("lead").rlike("[=:]>?\\\\?[\"'`]?$")),
        "quoted": flag(F.col("lead").rlike("[\"'`]$")),
        "benign_near": flag(near.rlike(_BENIGN)), "placeholder": flag(F.col("run").rlike(_PLACEHOLDER)),
        "named": flag(F.col("named")), "punctuation": share("[^A-Za-z0-9+/_=-]"),
        "url_password": flag(F.col("lead").rlike("://[^/]*:$")),
    }).drop("__covered", "lead")


def fit(findings: DataFrame, words: DataFrame, trees: int = 40, depth: int = 8, seed: int = 5) -> PipelineModel:
    """Train the forest on labelled findings: path, word, before2, before1, after and ``label`` (1 secret, 0 not).

    A label 0 holds for every candidate of the word, a label 1 for the last one: those
    before it count as 0 if they are names, and not at all otherwise.  Rows with
    another label, or whose word holds no candidate, are ignored; at least one row
    of each label is needed (ValueError).  Repeated rows count each; other columns are ignored.
    """
    findings = findings.select("path", "word", "before2", "before1", "after", "label")
    found = _expand(findings.where("label in (0, 1)").withColumn("__row", F.monotonically_increasing_id()))
    last = F.col("nth") == F.max("nth").over(Window.partitionBy("__row"))
    found = found.withColumn("__last", last).where("label = 0 or __last or named").withColumn(
        "label", F.when(F.col("__last"), F.col("label")).otherwise(F.lit(0)))
    rows = describe(found, words)
    rows = rows.select(*FEATURES, F.col("label").cast("double").alias("label"))
    if rows.select("label").distinct().count() < 2:
        raise ValueError("labelled findings of both kinds are needed")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="features", labelCol="label")
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(rows)


def secret_findings(docs: DataFrame, labelled: DataFrame, text_col: str = "text", path_col: str | None = "source",
                    carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every candidate of ``docs`` with its verdict: carried columns, position, secret, probability, is_secret.

    A text's repeated candidate is a finding at each position, and so are those of
    repeated rows.  Tables that are empty or without candidates give an empty
    result, and nothing is trained.  Columns that are not carried are ignored, whatever
    their names; a carried column may be called anything but like a result (ValueError).
    """
    spark = docs.sparkSession
    clash = {"position", "secret", "probability", "is_secret"} & set(carry)
    if clash:
        raise ValueError(f"carried columns are called like results: {sorted(clash)}")
    names = tuple(f"__c{i}" for i in range(len(carry)))
    back = [F.col(n).alias(c) for n, c in zip(names, carry, strict=True)]
    own = docs.select(*[F.col(c).alias(n) for c, n in zip(carry, names, strict=True)], F.col(text_col).alias("__text"),
                      (F.col(path_col) if path_col else F.lit(None)).cast("string").alias("__source"))
    found = materialise(spark, candidates(own, "__text", "__source", names), "candidates")
    if found.isEmpty():
        return found.select(*back, "position", F.col("run").alias("secret"), F.lit(0.0).alias("probability"), F.lit(False).alias("is_secret"))
    words = materialise(spark, dictionary(docs, text_col), "dictionary")
    scored = fit(labelled, words).transform(describe(found, words))
    return scored.select(*back, "position", F.col("run").alias("secret"),
                         vector_to_array("probability")[1].alias("probability")).withColumn(
        "is_secret", F.col("probability") >= THRESHOLD)


def redact(docs: DataFrame, labelled: DataFrame, text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """``docs`` with every secret of every text replaced by MASK; no row is dropped.

    Findings meet their texts by the MD5 of the text, so rows without an id
    and rows that share one are redacted too.  A secret is masked wherever the
    text has it; one that is no key-like run, only where no letter or digit adjoins it.
    """
    keyed = docs.withColumn("__text_key", F.md5(text_col))
    secrets = (secret_findings(keyed, labelled, text_col, path_col, ("__text_key",)).where("is_secret")
               .groupBy("__text_key").agg(F.collect_set("secret").alias("__secrets")))
    longest_first = F.array_sort("__secrets", lambda a, b: F.when(F.length(a) > F.length(b), -1).when(
        F.length(a) < F.length(b), 1).when(a < b, -1).when(a > b, 1).otherwise(0))
    apart = lambda s: F.concat(F.lit(r"(?<![A-Za-z0-9])\Q"), F.replace(s, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?![A-Za-z0-9])"))
    masked = F.aggregate(longest_first, F.col(text_col), lambda t, s: F.when(
        s.rlike(f"^{_RUN}$"), F.replace(t, s, F.lit(MASK))).otherwise(F.regexp_replace(t, apart(s), F.lit(MASK))))
    return keyed.join(secrets, "__text_key", "left").withColumn(
        text_col, F.when(F.col("__secrets").isNull(), F.col(text_col)).otherwise(masked)).drop("__text_key", "__secrets")


def labelled_findings(docs: DataFrame, documents: int = 250, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A stand-in table of labelled findings, since the test tables hold none: path, word, before2, before1, after, label.

    ``documents`` (the documented bound) picks that many documents by a hash of
    their id and text; each yields a few secret-like and a few harmless findings of usual
    formats, filled with digests of the id and words of the text.  The choice is made on
    hashes alone, ``documents`` of each task; only the chosen rows' texts are fetched.
    The findings are written once.  Equal rows count once; an empty table gives no findings.
    """
    base = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.coalesce(text_col, F.lit("")).alias("t"))
    base = base.withColumn("h", F.xxhash64("i", "t"))
    chosen = base.select("h").distinct().orderBy("h").limit(documents)          # `documents` numbers
    d = (base.join(F.broadcast(chosen), "h", "left_semi").dropDuplicates(["h"])
         .select("i", F.split(F.lower("t"), "[^a-z]+").alias("w")))
    hex40, hex64, alnum = F.sha1("i"), F.sha2("i", 256), F.regexp_replace(F.base64(F.unhex(F.sha2(F.concat("i", F.lit("k")), 512))), "[+/=\\s]", "")
    word = lambda k: F.coalesce(F.get("w", F.lit(k)), F.lit("word"))
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    digits = F.rpad(F.regexp_replace(F.sha2("i", 512), "[^0-9]", ""), 16, "7").substr(1, 16)
    uuid = F.concat_ws("-", hex40.substr(1, 8), hex40.substr(9, 4), hex40.substr(13, 4), hex40.substr(17, 4), hex40.substr(21, 12))
    compound = F.concat(word(3), word(4), word(5), word(6), word(7), word(8))

    letters = F.translate(F.upper(alnum), "0123456789", "QWZRTYUJKP")
    short = F.concat(alnum.substr(3, 5), F.get(F.split(F.lit("&!@$%#*?^~"), ""), F.pmod(F.xxhash64("i"), F.lit(10)).cast("int")), alnum.substr(8, 4))

    def finding(label: int, path: str, before2, before1, w, after=None):
        text = lambda c: F.lit(c) if isinstance(c, str) else c
        return F.struct(text(path).alias("path"), text(w).alias("word"), text(before2).alias("before2"),
                        text(before1).alias("before1"), (word(9) if after is None else text(after)).alias("after"),
                        F.lit(label).alias("label"))

    rows = F.array(
        finding(1, "src1", "token", "=", q(hex40)), finding(1, "src2", "TOKEN", "=", F.concat(q(F.upper(hex40)), F.lit("!!"))),
        finding(1, "src3", "token", "=", F.concat(q(hex40), F.lit("###"))),
        finding(1, "app/config.yaml", word(1), "password:", alnum.substr(1, 20)),
        finding(1, "app/.env", word(1), word(2), F.concat(F.lit("API_KEY="), alnum.substr(5, 32))),
        finding(1, "src4", "secret", "=", q(hex64)), finding(1, "src5", "Authorization:", "Bearer", alnum.substr(1, 60)),
        finding(1, "src6", word(1), "token:", F.concat(F.lit("ghp_"), alnum.substr(3, 36))),
        finding(1, "src7", "aws_access_key_id", "=", F.concat(F.lit("AKIA"), F.upper(alnum.substr(7, 16)))),
        finding(1, "src8", word(1), word(2), F.concat(F.lit("AWS_SECRET_ACCESS_KEY="), alnum.substr(9, 40))),
        finding(1, "app/.env", word(1), "export", F.concat(F.lit("GITHUB_ACCESS_TOKEN=ghp_"), alnum.substr(2, 36))),
        finding(1, "src9", word(1), word(2), F.concat(F.lit("https://host.com/api/v1/"), word(3), F.lit("/list?token="), hex40)),
        finding(1, "src2", word(1), word(2), F.concat(F.lit('{"access_token":"'), alnum.substr(11, 32), F.lit('","refresh_token":"'), hex40, F.lit('"}'))),
        finding(0, "src8", word(1), word(2), "AWS_SECRET_ACCESS_KEY_ID_2"), finding(0, "src9", "the", word(1), "aws_secret_access_key_name"),
        finding(0, "src2", word(1), word(2), F.concat(F.lit("https://host.com/api/v1/"), word(3), F.lit("/list/"), word(4), F.lit("/v2"))),
        finding(0, "src3", word(1), word(2), F.concat(F.lit("https://host.com/api/v2/item?commit="), hex40)),
        finding(1, "src4", word(1), word(2), F.concat(F.lit("AKIA"), letters.substr(1, 16))),
        finding(1, "src5", "key", "is", F.concat(F.lit("AKIA"), letters.substr(9, 16))),
        finding(1, "src1", word(1), "password:", short), finding(1, "src2", "password", "=", q(short)),
        finding(1, "app/.env", word(1), word(2), F.concat(F.lit("DB_PASSWORD="), alnum.substr(6, 10))),
        finding(1, "src6", word(1), word(2), F.concat(F.lit('{"password":"'), short, F.lit('"}'))),
        finding(1, "src3", word(1), word(2), F.concat(F.lit("postgres://user:"), short, F.lit("@host"))),
        finding(1, "src9", word(1), word(2), F.concat(F.lit("https://"), word(4), F.lit(":"), alnum.substr(8, 9), F.lit("@host.com/"), word(5))),
        finding(0, "src1", word(1), "password:", word(3)), finding(0, "src2", "token", "=", word(4)),
        finding(0, "src4", F.concat(F.lit("password="), short), word(1), word(2)), finding(0, "src5", word(1), F.concat(F.lit("token="), hex40), word(3)),
        finding(0, "src3", "password:", short, word(5)), finding(0, "src6", "Authorization:", word(1), F.concat(word(2), F.lit(","))),
        finding(0, "src7", word(1), "author:", F.initcap(word(4))), finding(0, "src8", "max_tokens", "=", digits.substr(1, 4)),
        finding(0, "src9", word(1), word(2), "auth=true"), finding(0, "src1", word(1), word(2), '{"token":null}'),
        finding(0, "src2", word(1), word(2), F.concat(F.lit("http://host:"), digits.substr(1, 4), F.lit("/"), word(3), F.lit("@"), word(4))),
        finding(0, "src3", word(1), word(2), F.concat(F.upper(word(3)), F.lit("_"), F.upper(word(4)), F.lit("_"), F.upper(word(5)), F.lit("_"), F.upper(word(6)))),
        finding(0, "src1", word(1), word(2), digits), finding(0, "src2", "card", word(2), digits),
        finding(0, "src3", word(1), word(2), F.concat(digits, F.lit("!!"))),
        finding(0, "src4", word(1), "commit", hex40), finding(0, "src5", "sha1", "=", q(hex40)),
        finding(0, "src6", "checksum", ":", hex64), finding(0, "src7", "id", "=", uuid), finding(0, "src8", word(1), word(2), uuid),
        finding(0, "src9", word(1), word(2), compound), finding(0, "src1", word(1), "token", compound),
        finding(0, "tests/fixtures.py", "token", "=", q(F.concat(F.lit("your_token_"), word(3), F.lit("_1234567")))),
        finding(0, "docs/example.md", "api_key", "=", "xxxxxxxxxxxxxxxx1234567"),
        finding(0, "src2", "token", "=", F.concat(word(3), F.lit("_"), word(4), F.lit("_"), word(5), F.lit("_"), word(6), F.lit("_2"))),
        finding(0, "src3", word(1), word(2), F.concat(F.lit("http://host/"), word(3), F.lit("/2024-01-02-"), word(4), F.lit("-"), word(5))),
    )
    # what the varied ones are made of: numbers, letters and digests of the id, in columns of their own
    stuff = F.transform(F.sequence(F.lit(1), F.lit(200)), lambda k: F.xxhash64("i", k))
    hexes = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(6)), lambda k: F.sha2(F.concat("i", k.cast("string")), 512)), "")
    plain = F.regexp_replace(F.base64(F.unhex(F.repeat(hexes, 2))), "[+/=\\s]", "x")
    varied = materialise(docs.sparkSession, d.select("w", stuff.alias("numbers"), hexes.alias("digits"), plain.alias("letters")), "findings_of")
    every = [d.select(F.explode(rows).alias("f"))]
    made = _varied_findings(word, finding)
    every += [varied.select(F.explode(F.array(*made[k:k + 6])).alias("f")) for k in range(0, len(made), 6)]
    return materialise(docs.sparkSession, functools.reduce(DataFrame.unionByName, every).select("f.*"), "labelled")


def _varied_findings(word, finding) -> list[F.Column]:
    """Findings whose keywords, separators, quotes, alphabets, lengths and trailing noise vary from document to document."""
    places: dict[str, int] = {}

    def number(name: str, below: int) -> F.Column:      # a number of the document for each name
        return F.pmod(F.get("numbers", F.lit(places.setdefault(name, len(places)))), F.lit(below))

    def pick(salt: str, *options: str) -> F.Column:
        return F.element_at(F.array(*map(F.lit, options)), (number(salt, len(options)) + 1).cast("int"))

    def letters(salt: str) -> F.Column:            # 80 letters and digits
        return F.substr("letters", (number(salt + " at", 500) + 1).cast("int"), F.lit(80))

    def between(salt: str, lo: int, hi: int) -> F.Column:
        return (number(salt + " size", hi - lo + 1) + lo).cast("int")

    def value(salt: str, lo: int, hi: int) -> F.Column:
        raw, hexa = letters(salt), F.substr("digits", (number(salt + " at", 500) + 1).cast("int"), F.lit(80))
        some = F.element_at(F.array(hexa, F.upper(hexa), F.translate(raw, "kqZ", "-_-"), F.lower(raw), F.translate(raw, "jwQ", "/+/"), raw), (number(salt + " kind", 6) + 1).cast("int"))
        return F.substr(some, F.lit(1), between(salt, lo, hi))

    def quoted(salt: str, c: F.Column) -> F.Column:
        return F.concat(pick(salt, '"', '"', "'", "`", ""), c, pick(salt, '"', '"', "'", "`", ""))

    noise = lambda salt: pick(salt, "", "", "", "", ",", ";", ".", "!!", "###", "***", "%%%", "$$$", "&&&")
    keyword = lambda salt: pick(salt, "token", "secret", "api_key", "apikey", "access_key", "auth_token", "password", "passwd", "pwd", "credential",
                                "private_key", "accessToken", "apiKey", "TOKEN", "Secret", "refresh_token")
    path = lambda salt: pick(salt, "src1", "src2", "app/main.py", "config/app.yaml", ".env", "server.js", "notes.txt")
    join = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    camel = lambda salt, first: join(word(first), *[F.initcap(word(first + k)) for k in (1, 2)], pick(salt, "", "ById", "V2", "From", "Handler"), F.initcap(word(first + 3)))
    base64 = F.concat(F.substr(F.translate(letters("b"), "kq", "+/"), F.lit(1), F.element_at(F.array(*map(F.lit, (27, 43, 86))), (number("b64", 3) + 1).cast("int"))), pick("b=", "=", "==", ""))
    digest = F.substr("digits", (number("d at", 500) + 1).cast("int"), F.lit(128))

    def at(label, salt, before2, before1, w, after=None):
        return finding(label, path("path" + salt), before2, before1, w, after)

    # formats of the tests that hold some out (tests/llm/test_secrets.py: HELD_OUT) have no template here
    return [
        at(1, "1", keyword("1"), pick("1s", "=", ":", ":=", "=>"), F.concat(quoted("1q", value("1", 16, 64)), noise("1n"))),
        at(1, "2", word(1), F.concat(keyword("2"), pick("2s", ":", "=")), F.concat(quoted("2q", value("2", 14, 48)), noise("2n"))),
        at(1, "3", word(1), pick("3x", "export", "set", "ENV", "-"), join(pick("3p", "MY_", "APP_", "PROD_", "", "SERVICE_"), F.upper(keyword("3")), pick("3s", "=", ":"), quoted("3q", value("3", 12, 64)))),
        at(1, "4", word(1), word(2), join('{"', keyword("4"), '":"', value("4", 16, 64), pick("4e", '"}', '",', '"}]'))),
        at(1, "5", word(1), word(2), F.concat(quoted("5q", F.concat(pick("5p", "ghp_", "gho_", "npm_", "hf_", "pypi-", "AIza", "SG."), F.substring(letters("5"), 1, 36))), noise("5n"))),
        at(1, "5b", word(1), word(2), F.concat(quoted("5r", join(F.substr(word(4), F.lit(1), between("5l", 2, 5)), pick("5t", "_", "-", "_test_", "_prod_", "."), F.substr(letters("5b"), F.lit(1), between("5b", 18, 44)))), noise("5m"))),
        at(1, "5c", word(1), pick("5u", "use", "key", "with", "="), join(F.substr(word(5), F.lit(1), between("5v", 2, 4)), "-", F.rpad(F.regexp_replace(digest, "[^0-9]", ""), 11, "4"), "-", F.substr(letters("5c"), F.lit(1), between("5c", 20, 36)))),
        at(1, "6", word(1), word(2), join("https://", word(3), ".com/", word(4), "?", word(5), "=1&", keyword("6"), "=", value("6", 16, 48))),
        at(1, "7", pick("7h", "Authorization:", '"Authorization":', "auth"), pick("7b", "Bearer", "Basic", "Token"), F.concat(value("7", 20, 70), noise("7n"))),
        at(1, "8", word(1), pick("8k", "password:", "passwd=", "pwd:", "PASSWORD:", "pass_phrase:", "secret:"),
           F.concat(F.substring(letters("8"), 1, 5), pick("8c", "!", "@", "#", "$", "%", "&", "*"), F.substring(letters("8"), 9, 6))),
        at(1, "9", word(1), word(2), join(pick("9u", "mysql", "redis", "https", "amqp", "mongodb"), "://", word(3), ":", value("9", 8, 24), "@", word(4), ".com/", word(5))),
        at(0, "a", word(1), word(2), F.concat(camel("a", 3), noise("an"))), at(0, "b", word(1), word(2), F.concat(camel("b", 4), pick("bn", "(", "();", "()", "."))),
        at(0, "c", keyword("c"), "=", F.concat(camel("c", 5), pick("cn", "()", "();", "", ","))),
        at(0, "d", pick("db", "integrity", "integrity=", "link"), pick("ds", "=", ":", "script"), quoted("dq", F.concat(pick("dp", "sha256-", "sha512-", "sha1-"), base64))),
        at(0, "e", word(1), word(2), join(pick("ep", "integrity=\"sha256-", "integrity='sha512-", "digest=sha256:"), base64)),
        at(0, "f", word(1), pick("fs", "src", "url:", "href"), join("data:image/", pick("fi", "png", "gif"), ";base64,", F.translate(letters("f"), "kq", "+/"))),
        at(0, "g", word(1), word(2), join("/usr/", word(3), "/", word(4), "/", word(5), pick("ge", ".txt", ".so", "", "/"))),
        at(0, "h", word(1), pick("hb", "src", "href", "file"), join(word(3), pick("hs", "-", "."), F.substr(digest, F.lit(1), between("h", 8, 24)), pick("he", ".js", ".css", ".min.js"))),
        at(0, "j", word(1), word(2), F.concat_ws("-", *[word(k) for k in range(3, 9)])),
        at(0, "k", word(1), word(2), join(pick("kp", "MAX_", "ENABLE_", "DEFAULT_", "USE_"), F.upper(keyword("k")), pick("ks", "_LENGTH_LIMIT", "_REFRESH_SECONDS", "_HEADER_NAME"))),
        at(0, "l", pick("lb", "commit", "revision", "tree", "parent", "etag", "checksum"), pick("ls", ":", "=", "is"), F.concat(quoted("lq", F.substr(digest, F.lit(1), pick("ln", "32", "40", "64").cast("int"))), noise("lz"))),
        at(0, "m", pick("mb", "id", "uuid", "request_id", "trace"), pick("ms", ":", "=", ""), quoted("mq", F.concat_ws("-", *[F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))),
        at(0, "n", keyword("n"), pick("ns", "=", ":"), quoted("nq", pick("nv", "<your-token-here>", "changeme_changeme", "REDACTED_REDACTED", "${SERVICE_TOKEN}", "your-api-key-goes-here", "insert_your_key_here"))),
        at(0, "o", keyword("o"), "=", join(pick("ov", "os.environ['", "process.env.", "config.get('", "settings."), F.upper(keyword("o2")), pick("oe", "']", "", "')", ";"))),
        at(0, "p", word(1), word(2), F.concat(F.rpad(F.regexp_replace(digest, "[^0-9]", ""), 16, "3"), noise("pn"))),
        at(0, "q", pick("qb", "card", "phone", "order", "ref"), pick("qs", ":", "no", "="), F.concat_ws("-", *[F.rpad(F.regexp_replace(F.substring(digest, 20 * k + 1, 20), "[^0-9]", ""), 4, "5") for k in range(4)])),
        at(0, "r", pick("rb", "from", "until", "date:"), word(2), F.concat(F.lit("2024-0"), F.substring(F.regexp_replace(digest, "[^1-9]", ""), 1, 1), F.lit("-11T10:20:30.000Z"))),
        at(0, "s", word(1), "class", join('"', word(3), "-", word(4), "--", word(5), "__", word(6), '"')),
        at(0, "t", word(1), word(2), join("com/", word(3), "/", word(4), "/", F.initcap(word(5)), F.initcap(word(6)), pick("te", ".java", ".class", ""))),
        at(0, "u", word(1), word(2), join("https://", word(3), ".com/", word(4), "/", word(5), "-", word(6), "-", word(7), "?page=", between("u", 1, 99).cast("string"))),
    ]
