"""Secret scan: candidates by pattern, false positives removed by a random forest.

Texts are cut into words; assignment signs become words of their own. A candidate is a
word that looks generated (16 or more characters with a digit or mixed case), or one of
8 or more that follows a name such as ``password``. A value that is assigned to such a
name, or the password of ``scheme://user:password@host``, is a candidate of any length and
is taken before the text is cut: in quotes up to the closing quote of the line, bare up to
white space, to ``;``, ``&`` or ``,`` before another name or a space, or to a closing quote
or bracket of the text around it. The forest sees its length,
its character transitions and entropy, how much of it a small dictionary covers, what the
path says, and the neighbouring words. It learns from labelled findings: texts of which
every candidate is (or is not) a secret. Everything is column expressions; only words of
texts that can hold a candidate are looked at one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .base import stored, words_text

TREES, DEPTH, SEED = 40, 7, 11
#: Documents from which labelled findings are made (each gives about 20).
LABELLED_FROM = 250
BEFORE, AFTER = 5, 3

NAMED = r"(?i)^[a-z0-9_.-]*(pass|passwd|password|pwd|secret|token|apikey|api_key|api-key|auth|bearer|credential|private|access_key)[a-z0-9_.-]*$"
CUT = r"""[\s"'`,;(){}\[\]<>|&?#$%*!]+"""
VALUE = r"^[A-Za-z0-9+/_.~@-]{8,}$"
MADE = r"^(?=.{16,}$)(?:(?=.*[0-9])|(?=.*[a-z])(?=.*[A-Z])(?!^[A-Z][a-z]+$)).*$"
KNOWN = r"^(AKIA|ASIA|ghp_|gho_|github_pat_|sk_live_|xox[abp]-|AIza|eyJ|glpat-)"
#: What a text must hold to have a candidate: a name in any case, a run of 16 signs of a
#: value, or a password in a URL. Three searches that skip most places at their first sign.
MAYBE = (
    r"(?=[pPsStTaAbBcC])(?i:pass|pwd|secret|token|api.?key|auth|bearer|credential|private|access_?key)",
    r"(?<![A-Za-z0-9+/_.~@-])[A-Za-z0-9+/_.~@-]{16}",
    r"://[^\s/:@]*:[^\s/]+@",
)

#: Marks put around values before the text is cut; in texts they count as white space.
VALUE_OPEN, VALUE_CLOSE, URL_OPEN, URL_CLOSE = "\x01", "\x02", "\x03", "\x04"
WORD_OPEN, WORD_CLOSE = "\x05", "\x06"
MARKS = [VALUE_OPEN, VALUE_CLOSE, URL_OPEN, URL_CLOSE, WORD_OPEN, WORD_CLOSE]
_KEY = r"(?i:pass|pwd|secret|token|api[_.-]?key|auth|bearer|credential|private|access_?key)"
_SCHEME = r"(?:(?i:bearer|basic|token)[ \t]++)?+"
_HEAD = (
    rf"(?:{_KEY}[A-Za-z0-9_.-]*+(?:\\*+[\"'`])?+[\])}}]?+"
    r"(?:[ \t]*:[ \t]*(?i:str|string|bytes|Optional\[str\])(?=[ \t]*=))?+"
    r"[ \t]*+[?+|!]{0,2}[=:](?:[=:>~]|[ \t]++(?=[=:]))*+"
    rf"|(?<![A-Za-z0-9_-])--[A-Za-z0-9-]{{0,40}}?{_KEY}[A-Za-z0-9-]*+[ \t]++(?!-))"
)
_BARE = (
    r"(?![\s,;)\]}\x03])(?:\([^\s()]*+\)|\[[^\s\[\]]*+\]|\{[^\s{}]*+\}|<[^\s<>]*+>|[^\s\"'`;&,)\]}>]"
    r"|[)\]}>](?![\s\"'`,;)\]}>]|$)|[;&,](?![A-Za-z0-9_.-]*+[ \t]*+[=:]|[\s\"'`)\]}]|$)|[\"'`](?=[A-Za-z0-9]))++"
)
ASSIGNED = (
    # one look at the first letter and the name before the three forms are tried
    rf"(?=[PpSsTtAaBbCc-])(?={_KEY}|--)(?:"
    rf"({_HEAD}\s*+[rbfuRBFU@$]{{0,2}}(\\*+(?:\"{{3}}|'{{3}}|[\"'`])){_SCHEME})((?:(?!\2)(?:\\[^\n]|[^\\\n]))++)(?=\2)"
    rf"|({_HEAD}[ \t]*+[\"'`]*+{_SCHEME})({_BARE})"
    rf"|({_KEY}[A-Za-z0-9_.-]*+>)([^<\n]++)(?=</))"
)
IN_URL = r"(://[^\s/:@\"'`<>]*+:)([^\s/\"'`<>]+)(?=@[A-Za-z0-9_\[])"

#: Words that written identifiers and placeholders are made of.
DICTIONARY = (
    "access account action address admin alpha api array auth author backup base beta block board "
    "body book branch buffer build cache change check class client code color column commit config "
    "connect content control copy count create current custom data date debug default delete demo "
    "desk detail digest domain dummy email enable error event example fake field file filter first "
    "folder form format frame function global group handler hash header hello here host image index "
    "info input insert instance item json key label last layer length level library line link list "
    "load local login machine main make manager map message method mock mode model module month name "
    "network node note null number object option order output owner package page param parse pass "
    "password path pattern place placeholder player plugin point policy port post private process "
    "product profile project public query queue random read record release remote replace report "
    "request reset result return role root route sample schema search secret section server service "
    "session setting size sort source stable start state status stop storage string style submit "
    "system table target task temp test text thread time title token total type unit update user "
    "value version view week window word world write year your"
).split()
NEAR_SECRET = r"(?i)(pass|pwd|secret|token|api.?key|auth|bearer|credential|private|access_key)"
NEAR_OTHER = r"(?i)(commit|sha|md5|hash|checksum|digest|uuid|guid|version|revision|build|invoice|card|phone|order|file|request|trace|example|sample)"
STRONG = r"(?i)(password|passwd|passphrase|pwd|secret|token|api[_.-]?key|credential|access_?key|private[_.-]?key|(^|[_.-])pass$|bearer|authorization)"
CODE = (
    r"^[$%]\{?[A-Za-z_]+\}?$|^\$\(|^[A-Za-z_][A-Za-z0-9_.]*[(\[]|\{\{|^<.*>$|^[A-Za-z_]+(\.[A-Za-z_]+)+$"
    r"|^(?i:null|none|nil|true|false|undefined|string|str|bytes|text|required|optional|empty|unknown|changeme|n/a)$"
)
TEST_PATH = r"(?i)(test|spec|example|sample|fixture|mock|doc|readme)"

FEATURES = [
    "length", "digits", "uppers", "symbols", "switches", "vowel_switches", "entropy", "covered",
    "hex", "assigned", "named", "near_secret", "near_other", "test_path", "prefixed", "repeats",
    "strong", "in_url", "code", "spaces",
]


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.length(value)


def _entropy(value: Column) -> Column:
    chars = F.split(value, "")
    each = F.transform(
        F.array_distinct(chars),
        lambda c: F.length(value) - F.length(F.replace(value, c, F.lit(""))),
    )
    bits = F.aggregate(
        F.filter(each, lambda n: n > 0),
        F.lit(0.0),
        lambda s, n: s - (n / F.length(value)) * F.log2(n / F.length(value)),
    )
    return bits


def _marked(text: Column) -> Column:
    """A text with marks around the values of assignments and the passwords of URLs. A
    value of one word has marks of its own."""
    text = F.translate(text, "".join(MARKS), " " * len(MARKS))
    text = F.regexp_replace(text, IN_URL, f"$1{URL_OPEN}$2{URL_CLOSE}")
    text = F.regexp_replace(text, ASSIGNED, f"$1$4$6{VALUE_OPEN}$3$5$7{VALUE_CLOSE}")
    word = f"([^=:{''.join(MARKS)}{CUT[1:-2]}]+)"
    one = f"{VALUE_OPEN}{word}{VALUE_CLOSE}|{URL_OPEN}{word}{URL_CLOSE}"
    return F.regexp_replace(text, one, f"{WORD_OPEN}$1$2{WORD_CLOSE}")


def _name(before: Column) -> Column:
    """The last of the words that is not an assignment sign."""
    return F.element_at(F.filter(before, lambda w: ~w.isin("=", ":")), -1)


def find_candidates(docs: DataFrame, text_col: str, path_col: str | None, keep: list[str]) -> DataFrame:
    """A row per candidate: ``keep`` columns, ``at`` (word number), ``value``, its
    neighbours ``before`` and ``after``, and ``path``. Of a value of several words ``at``
    is the number of the first; words in it that look generated have rows of their own."""
    text = words_text(docs[text_col])
    path = words_text(docs[path_col].cast("string")) if path_col else F.lit("")
    rows = docs.select(
        *[docs[c].alias(f"__keep_{c}") for c in keep], text.alias("__text"), path.alias("path")
    ).filter(reduce(Column.__or__, [F.col("__text").rlike(p) for p in MAYBE]))
    rows = rows.withColumn("__text", _marked(F.col("__text")))
    spaced = F.regexp_replace("__text", f"[=:{''.join(MARKS)}]", " $0 ")
    rows = rows.withColumn("raw", F.split(spaced, CUT))

    marks = F.filter(
        F.transform("raw", lambda w, i: F.when(w.isin(MARKS), F.struct(i.alias("i"), w.alias("w")))),
        lambda m: m.isNotNull(),
    )
    rows = rows.withColumns({"marks": marks, "words": F.filter("raw", lambda w: ~w.isin(MARKS))})
    # how many marks stand before each place of the raw words, and before their end
    until = F.concat(F.transform("marks", lambda m: m["i"]), F.array(F.size("raw")))
    passed = F.transform(
        until, lambda m, k: F.array_repeat(k, m - F.coalesce(F.get("marks", k - 1)["i"], F.lit(-1)))
    )
    rows = rows.withColumn("passed", F.flatten(passed))

    def spans(opening: str, closing: str) -> Column:
        """Place of each mark and of its end among the raw words, with the value."""
        at = lambda mark: F.transform(F.filter("marks", lambda m: m["w"] == mark), lambda m: m["i"])
        values = F.regexp_extract_all("__text", F.lit(f"{opening}([^{closing}]*){closing}"), F.lit(1))
        return F.transform(
            F.arrays_zip(at(opening).alias("i"), at(closing).alias("end"), values.alias("v")),
            lambda z: F.struct(
                z["i"].alias("i"), z["end"].alias("end"), F.translate(z["v"], "".join(MARKS), "").alias("value")
            ),
        )

    def chosen(word: Column, i: Column) -> Column:
        before = F.when(i >= 1, F.get("raw", i - 1))
        name = F.when(
            before.isin("=", ":"), _name(F.slice("raw", F.greatest(i - 3, F.lit(1)), F.least(i, F.lit(4))))
        ).otherwise(before)
        named = F.coalesce(name.rlike(NAMED), F.lit(False))
        looks = word.rlike(MADE) | word.rlike(KNOWN) | named & ~word.rlike(NAMED)
        looks = (F.length(word) >= 8) & word.rlike(VALUE) & looks
        return F.when(looks | F.coalesce(before == WORD_OPEN, F.lit(False)), i)

    single = F.transform(
        F.filter(F.transform("raw", chosen), lambda i: i.isNotNull()),
        lambda i: F.struct(i.alias("i"), (i + 1).alias("end"), F.get("raw", i).alias("value")),
    )

    def numbered(c: Column) -> Column:
        """A candidate with the numbers of its words instead of the places of the raw ones."""
        return F.struct(
            (c["i"] - F.get("passed", c["i"])).alias("i"),
            (c["end"] - F.get("passed", c["end"])).alias("end"),
            c["value"].alias("value"),
        )

    def among(c: Column) -> Column:
        """A candidate with its neighbours, so that its row carries no other words."""
        first = F.greatest(c["i"] - BEFORE, F.lit(0))
        return F.struct(
            c["i"].cast("long").alias("at"),
            c["value"].alias("value"),
            F.slice("words", first + 1, c["i"] - first).alias("before"),
            F.slice("words", c["end"] + 1, F.lit(AFTER)).alias("after"),
        )

    places = F.concat(single, spans(VALUE_OPEN, VALUE_CLOSE), spans(URL_OPEN, URL_CLOSE))
    # the list is exploded as it is: of a column Spark makes a filter that cuts the text per word
    found = rows.withColumn("c", F.explode(F.transform(F.transform(places, numbered), among)))
    return found.select(*[F.col(f"__keep_{c}").alias(c) for c in keep], "c.*", "path")


def with_features(found: DataFrame) -> DataFrame:
    value = F.col("value")
    signs = F.filter(F.transform("before", lambda w: F.rtrim(w, F.lit("\\"))), lambda w: w != "")  # escaped quotes
    last = F.element_at(signs, -1)
    assigned = F.coalesce(F.when(F.size(signs) > 0, last.isin("=", ":")), F.lit(False))
    name = F.when(F.size(signs) > 0, _name(signs))
    around = F.array_join(F.concat("before", "after"), " ")
    cover = "(?i)(" + "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w))) + ")"
    number = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    columns = {
        "length": F.length(value),
        "digits": _share(value, "[0-9]"),
        "uppers": _share(value, "[A-Z]"),
        "symbols": _share(value, "[^A-Za-z0-9]"),
        "switches": _share(value, "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])"),
        "vowel_switches": _share(value, "(?i)(?<=[aeiou])(?=[b-df-hj-np-tv-z])|(?<=[b-df-hj-np-tv-z])(?=[aeiou])"),
        "entropy": _entropy(value),
        "covered": 1 - F.length(F.regexp_replace(value, cover, "")) / F.length(value),
        "hex": value.rlike("^(?i:[0-9a-f]+)$"),
        "assigned": assigned,
        "named": name.rlike(NAMED),
        "near_secret": around.rlike(NEAR_SECRET),
        "near_other": around.rlike(NEAR_OTHER),
        "test_path": F.col("path").rlike(TEST_PATH),
        "prefixed": value.rlike(KNOWN),
        "repeats": _share(value, r"(.)(?=\1)"),
        "strong": name.rlike(STRONG),
        "in_url": assigned & name.startswith("//"),
        "code": value.rlike(CODE),
        "spaces": _share(value, r"\s"),
    }
    return found.select("*", *[number(columns[c]).alias(c) for c in FEATURES])


def labelled_texts(docs: DataFrame, text_col: str = "text", n: int = LABELLED_FROM) -> DataFrame:
    """Labelled findings ``text``, ``path``, ``label``, ``form`` in the words of ``n`` documents.

    The documents are the ones with the smallest hashes of their texts. Their hashes,
    written as keys of many kinds, are put among their words as secrets, and as checksums,
    ids, numbers, names and placeholders, which are not. ``form`` is the number of the way
    a finding is written, by which a test can hold out whole ways.
    """
    text = words_text(docs[text_col])
    long = docs.select(text.alias("t"), F.xxhash64(text).alias("h")).filter("length(t) > 20")
    least = [r["h"] for r in long.select("h").distinct().orderBy("h").limit(n).collect()]
    some = long.filter(F.col("h").isin(least)).dropDuplicates(["h"])
    words = F.slice(F.filter(F.split("t", CUT), lambda w: w.rlike(r"^\p{L}{2,}$")), 1, 8)
    w = lambda i: F.coalesce(F.get("w", F.lit(i)), F.lit("of"))
    sha = lambda k: F.sha1(F.concat("t", F.lit(k)))
    b64 = lambda k: F.regexp_replace(F.base64(F.unhex(F.sha2(F.concat("t", F.lit(k)), 256))), "=", "")
    md5 = lambda k: F.md5(F.concat("t", F.lit(k)))
    uuid = F.regexp_replace(md5("u"), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    number = F.substring(F.regexp_replace(F.concat(sha("n"), sha("m")), "[a-f]", ""), 1, 16)
    mixed = F.concat(F.substring(b64("p"), 1, 13), F.lit("7x"))
    bit = lambda k, i, n: F.substring(b64(k), i, n)
    signed = lambda k: F.concat(
        bit(k, 1, 3), F.lit("#"), bit(k, 4, 2), F.lit("!"), bit(k, 6, 2), F.lit("$"), bit(k, 8, 3)
    )
    short = lambda k: F.concat(bit(k, 1, 4), F.lit("7"), bit(k, 5, 2))

    def case(label: int, *parts, path: str = "src/main"):
        parts = [F.lit(p) if isinstance(p, str) else p for p in parts]
        body = F.concat(w(0), F.lit(" "), w(1), F.lit(" "), *parts, F.lit(" "), w(2), F.lit(" "), w(3))
        return F.struct(F.lit(label).alias("label"), body.alias("text"), F.lit(path).alias("path"))

    cases = F.array(
        case(1, 'token = "', sha("a"), '"'),
        case(1, F.upper(F.concat(F.lit('token = "'), sha("b"), F.lit('"')))),
        case(1, "secret_key: ", b64("c")),
        case(1, "password=", mixed),
        case(1, "aws id AKIA", F.upper(F.substring(F.regexp_replace(b64("d"), "[^A-Za-z]", "Q"), 1, 16))),
        case(1, "ghp_", F.substring(F.regexp_replace(b64("e"), "[^A-Za-z0-9]", "7"), 1, 36)),
        case(1, "Authorization: Bearer ", b64("f")),
        case(1, 'api_key = "', md5("g"), '"'),
        case(1, "client_secret: '", sha("h"), "'", path="deploy/values"),
        case(1, "DB_PASSWORD = ", F.substring(b64("i"), 1, 20)),
        case(1, 'DB_PASSWORD="', signed("q"), '"'),
        case(1, "password=", signed("r")),
        case(1, "root_pwd := '", short("s"), "'"),
        case(1, "if password == ", short("t")),
        case(1, "Password: ", short("v")),
        case(1, "postgres://app:", F.substring(b64("x"), 1, 10), "@db/x"),
        case(1, "amqp://", w(4), ":", signed("y"), "@mq.", w(5), ".net:5672/", w(6)),
        case(1, "secret = '", F.lower(w(4)), "7", short("z"), "'"),
        case(0, "password = None"),
        case(0, 'password = "${DB_PASSWORD}"'),
        case(0, "password=$", F.upper(w(4))),
        case(0, "password = os.getenv('", F.upper(w(4)), "')"),
        case(0, "token = self.", F.lower(w(4)), ".", F.lower(w(5))),
        case(0, 'password_label: "', w(4), " ", w(5), " ", w(6), '"'),
        case(0, "password: string"),
        case(0, "token: ", w(4)),
        case(0, "author: ", w(4), " ", w(5)),
        case(0, "author = ", F.substring(sha("A"), 1, 6)),
        case(0, "passed: ", F.substring(number, 1, 3)),
        case(0, 'secret = "<your-secret>"'),
        case(0, 'pwd = "********"'),
        case(0, "mysql://user:password@localhost/", w(4)),
        case(0, "https://", w(4), ":${TOKEN}@", w(5), ".com/"),
        case(0, F.initcap(F.concat(w(4), w(5), w(6), w(7))), "."),
        case(0, w(1), " ", F.initcap(F.concat(w(5), w(6), w(4))), "."),
        case(0, "commit ", sha("j")),
        case(0, "sha1 checksum: ", sha("k")),
        case(0, "md5 = ", md5("l")),
        case(0, number),
        case(0, "card ", number),
        case(0, "request id: ", uuid),
        case(0, w(4), "_", w(5), "_", w(6), "_Name2"),
        case(0, w(4), "-", w(5), "-", w(6), "-2023.04.11"),
        case(0, 'token = "your_token_here_example1"', path="docs/example"),
        case(0, "api_key = xxxxxxxxxxxxxxxxxxxx"),
        case(0, 'password = "changeme_placeholder"', path="tests/test_login"),
        case(0, w(4), ".", number, "@mail.example.com"),
        case(0, "image ", F.concat(w(4), w(5), w(6), F.lit("ViewController1"))),
        case(0, "secret = get_secret_from_config_file2"),
    )
    made = some.withColumn("w", words).select(F.posexplode(cases).alias("form", "c"))
    return made.select("c.text", "c.path", "c.label", "form")


def fit(labelled: DataFrame, seed: int = SEED) -> PipelineModel | None:
    """A forest from labelled findings ``text``, ``path``, ``label``; None without both labels."""
    found = with_features(find_candidates(labelled, "text", "path", ["label"]))
    rows = stored(found.select(F.col("label").cast("double").alias("label"), *FEATURES), "labelled")
    if rows.select("label").distinct().limit(2).count() < 2:
        return None
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=seed
    )
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(rows)


def scan(
    docs: DataFrame,
    model: PipelineModel | None,
    text_col: str = "text",
    path_col: str | None = "source",
    threshold: float = 0.5,
) -> DataFrame:
    """A row per candidate: ``doc_id``, ``at``, ``length``, ``value_sha256``, ``score``, ``secret``.

    ``at`` is the number of the word in its text; the value itself is only given as a
    digest. Null and empty texts have no candidates, a null path says nothing, repeated
    rows give repeated findings, an empty table none; other columns are not looked at.
    Without a model every candidate stays, with score 1.
    """
    found = with_features(find_candidates(docs, text_col, path_col, ["doc_id"]))
    if model is None:
        scored = found.withColumn("score", F.lit(1.0))
    else:
        scored = model.transform(found).withColumn(
            "score", F.element_at(vector_to_array("probability"), 2)
        )
    return scored.select(
        "doc_id",
        "at",
        F.length("value").cast("long").alias("length"),
        F.sha2("value", 256).alias("value_sha256"),
        F.round("score", 6).alias("score"),
        (F.col("score") >= threshold).alias("secret"),
    )
