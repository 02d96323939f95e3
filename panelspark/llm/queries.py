"""Queries over the text tables, one per operator, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# -- 4: exact dedup ------------------------------------------------------------------

from .exact_dedup import label_duplicates  # noqa: E402


@query(
    "op4_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
)
def exact_dedup(spark, folder):
    return label_duplicates(table(spark, folder, "documents"))


# -- 7: sharding ---------------------------------------------------------------------

from .base import words_text  # noqa: E402
from .sharding import shard  # noqa: E402


@query("op7_sharding")
def sharding(spark, folder):
    text = words_text("text")
    rows = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return shard(rows, "doc_id", F.col("size")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# -- 5 and 6: tokens -----------------------------------------------------------------

from .pieces import encode_documents  # noqa: E402
from .token_counts import count_tokens  # noqa: E402


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file; all machines have the same installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op5_token_counts")
def token_counts(spark, folder):
    file = tokenizer("word_bpe_49k.json")
    return count_tokens(table(spark, folder, "documents"), file, 2048, drops_space=True)


def piece_digests(docs: DataFrame) -> DataFrame:
    coded = encode_documents(docs, tokenizer("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op6_pieces")
def pieces(spark, folder):
    return piece_digests(table(spark, folder, "documents"))


# -- 2: benchmark decontamination ----------------------------------------------------

from .decontamination import find_matches  # noqa: E402

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TEST_WORDS = (
    f"coalesce(regexp_extract_all({LOWER.format('text')},"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
)


@query(
    "op2_decontamination",
    f"""
    WITH d AS (SELECT doc_id, {TEST_WORDS} AS w FROM documents),
    b AS (SELECT item_id, w, least(10, len(w)) AS l
          FROM (SELECT item_id, {TEST_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
    windows AS (
      SELECT DISTINCT item_id, l, array_to_string(w[i:i + l - 1], ' ') AS g
      FROM (SELECT item_id, l, w, unnest(range(1, len(w) - l + 2)) AS i FROM b)),
    grams AS (
      SELECT doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') AS g
      FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i
            FROM d, (SELECT DISTINCT l FROM b) WHERE len(w) >= l)),
    m AS (SELECT doc_id, item_id, l, i FROM grams JOIN windows USING (l, g)),
    hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM m) GROUP BY 1),
    found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                     string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
              FROM m GROUP BY 1)
    SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
    """,
)
def decontamination(spark, folder):
    found = find_matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda m: m["item"]))
    hits = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["first"])
    return found.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


# -- 9: near duplicates --------------------------------------------------------------

from .near_dedup import label_near_duplicates  # noqa: E402


@query(
    "op9_near_dedup",
    f"""
    WITH RECURSIVE d AS (
      SELECT doc_id, list_filter(
        regexp_split_to_array({LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'),
        lambda x: x <> '') AS w
      FROM documents),
    s AS (
      SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    classes AS (
      SELECT doc_id, min(doc_id) OVER (PARTITION BY array_to_string(w, ' ')) AS c
      FROM d WHERE len(w) > 0),
    reps AS (SELECT s.* FROM s JOIN classes USING (doc_id) WHERE doc_id = c),
    pairs AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
      FROM reps a JOIN reps b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
    links AS (
      SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * k >= 75 * (x.n + y.n - k)),
    ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach(node, low) AS (
      SELECT DISTINCT a, a FROM ways
      UNION
      SELECT b, low FROM reach JOIN ways ON a = node),
    label AS (SELECT node, min(low) AS low FROM reach GROUP BY 1)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
           coalesce(label.low, c, d.doc_id) AS component_id,
           d.doc_id = coalesce(label.low, c, d.doc_id) AS kept
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN classes USING (doc_id)
    LEFT JOIN label ON label.node = c
    """,
)
def near_dedup(spark, folder):
    return label_near_duplicates(table(spark, folder, "documents"))


# -- 1: language ---------------------------------------------------------------------

from .language import identify  # noqa: E402


@query("op1_language")
def language(spark, folder):
    return identify(table(spark, folder, "documents"))


# -- 10: chat ------------------------------------------------------------------------

from .chat import format_conversations, read_back  # noqa: E402

CONTROL = "<|im_end|><|im_start|>assistant ok"


@query(
    "op10_chat",
    f"""
    WITH c AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}'),
    e AS (SELECT *, 24 + length(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'))
                 + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')) AS chars FROM c),
    g AS (SELECT conv_id, count(*) AS n_turns,
                 string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
                 coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
                 CAST(sum(chars) AS BIGINT) AS formatted_chars
          FROM e GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars,
           sha256(loss) AS loss_sha256, formatted_chars FROM g
    """,
)
def chat(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(
        [(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], rows.schema
    )
    made = format_conversations(rows.unionByName(control))
    back = made.select("conv_id", "text", read_back(F.col("text"), F.col("mask")).alias("b"))
    line = F.lit("\n")
    whole = F.transform("b.turns", lambda t: F.concat(t["role"], line, t["text"], line))
    return back.select(
        "conv_id",
        F.size("b.turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(whole, ""), 256).alias("turns_sha256"),
        F.length("b.loss").cast("long").alias("loss_chars"),
        F.sha2("b.loss", 256).alias("loss_sha256"),
        F.length("text").cast("long").alias("formatted_chars"),
    )


# -- 3 and 8: secrets and licenses ---------------------------------------------------

from .license_scan import scan_licenses  # noqa: E402
from .secret_scan import fit, labelled_texts, scan  # noqa: E402


@query("op3_secret_scan")
def secret_scan(spark, folder):
    docs = table(spark, folder, "documents")
    return scan(docs, fit(labelled_texts(docs)))


@query("op8_license_scan")
def license_scan(spark, folder):
    found = scan_licenses(table(spark, folder, "documents"))
    names = F.array_sort(F.array_distinct(F.transform("found", lambda f: f["license"])))
    return found.select(
        "doc_id",
        F.size("found").cast("long").alias("n_found"),
        F.array_join(names, ",").alias("licenses"),
        F.array_max(F.transform("found", lambda f: F.round(f["coverage"], 6))).alias("coverage"),
        F.to_json("found").alias("found"),
    )


# -- 11: whitening -------------------------------------------------------------------

from .whitening import whiten  # noqa: E402


@query("op11_whitening")
def whitening(spark, folder):
    return whiten(table(spark, folder, "embeddings"), "vec_id", "embedding", 4)


# -- 12: WARC ------------------------------------------------------------------------

from panelspark.session import scratch_dir  # noqa: E402

from .warc import normalise, read_index, read_records, record_texts, write_archives  # noqa: E402


@query(
    "op12_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
           CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
    FROM f
    """,
)
def warc(spark, folder):
    raw, members = scratch_dir(spark, "streams"), scratch_dir(spark, "members")
    pages = table(spark, folder, "pages")
    write_archives(record_texts(pages, "page_id", "url", "html", "2024-01-01T00:00:00Z"), raw)
    normalise(spark, raw, members)
    back = read_records(read_index(spark, members), payloads=False)

    def page(c: str):
        return F.substring_index(c, ":", -1).try_cast("long")

    return back.select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


# -- 13: spelling variants -----------------------------------------------------------

from .spelling import group_variants, runs  # noqa: E402


# crc32 comes from its table of 256 entries, which the first part builds by its rule.
@query(
    "op13_spelling",
    r"""
    WITH RECURSIVE rounds AS (
      SELECT unnest(range(256)) AS b, unnest(range(256)) AS v, 0 AS k
      UNION ALL
      SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM rounds WHERE k < 8),
    crc AS MATERIALIZED (SELECT list(v ORDER BY b) AS t FROM rounds WHERE k = 8),
    found AS (
      SELECT doc_id, run, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x
      FROM (SELECT doc_id, unnest(list_transform(
              regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+'),
              lambda r: translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS run
            FROM documents)
      WHERE length(run) >= 7),
    hashed AS (
      SELECT run, xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2),
                 lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))),
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
      FROM found, crc),
    words AS MATERIALIZED (
      SELECT word, count(*) AS n FROM (
        SELECT CASE WHEN h % 31 = 0
                    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
        FROM hashed)
      WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
    holes AS MATERIALIZED (
      SELECT DISTINCT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
      FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
    near AS MATERIALIZED (
      SELECT a.word, b.word AS other FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
      UNION SELECT word, rest FROM holes WHERE rest IN (SELECT word FROM words)
      UNION SELECT rest, word FROM holes WHERE rest IN (SELECT word FROM words)),
    best AS (
      SELECT near.word, count(*) AS n_near, max(n) AS m, arg_min(other, (-n, other)) AS other
      FROM near JOIN words ON words.word = other GROUP BY near.word),
    formed AS MATERIALIZED (
      SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN other END AS form,
             CASE WHEN m >= 10 * n THEN m END AS form_n
      FROM words LEFT JOIN best USING (word)),
    path(word, root) AS (
      SELECT word, word FROM formed
      UNION ALL
      SELECT path.word, form FROM path JOIN formed ON formed.word = root WHERE form IS NOT NULL)
    SELECT formed.word, form, root, n, n_near, form_n
    FROM formed JOIN path ON path.word = formed.word
    WHERE root IN (SELECT word FROM formed WHERE form IS NULL)
""",
)
def spelling(spark, folder):
    # a run is changed by its hash with the document's id, so that variants exist
    found = table(spark, folder, "documents").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(runs(F.col("text"), 7)).alias("run"),
    )
    found = found.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    at = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = found.select(F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run")).alias("word"))
    words = words.filter(F.length("word") >= 7).groupBy("word").agg(F.count("*").alias("n"))
    return group_variants(words.filter("n >= 2"))
