"""Parsing, text, labels, lookups and recency, per row."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidewire.functions import polarity, text
from tidewire.operators import archive, archive_files, classify, dedup, places, prepare, recent
from tidewire.operators.models import stored_classifier
from tidewire.registry import Entry
from tidewire.registry import inputs as given
from tidewire.registry.inputs import table
from tidewire.session import scratch_folder, shared_folder
from tidewire.sources.messages import decode, read_collection
from tidewire.sources.sinks import BatchTable, encode_json

# --- parsing and null handling ---------------------------------------------------------------

_PAYLOAD_SQL = """
    CASE event_type WHEN 'error' THEN 'not json'
        WHEN 'signup' THEN '{"k": "' || user_id || 'x"}' ELSE props END"""


_K = StructType([StructField("k", IntegerType(), True)])


def _payloads(spark, folder):
    """The numbers in props, with broken payloads and wrongly typed fields among them."""
    wrong = F.concat(F.lit('{"k": "'), F.col("user_id"), F.lit('x"}'))
    payload = F.when(F.col("event_type") == "error", "not json").when(
        F.col("event_type") == "signup", wrong).otherwise(F.col("props"))
    return table(spark, folder, "events").select("event_id", payload.alias("json"))


def json_parse(spark, folder):
    return prepare.json_parse(_payloads(spark, folder), _K, keep=["event_id"])


def json_rejects(spark, folder):
    parsed = prepare.json_parse(_payloads(spark, folder), _K, keep=["event_id"],
                                rejects="payload")
    return prepare.rejected(parsed, "payload", keep=["event_id"])


def encode(spark, folder):
    events = table(spark, folder, "events")
    messages = encode_json(events, ["event_id", "event_type", "value", "props"])
    return decode(messages, "payload")


def null_fill(spark, folder):
    holed = table(spark, folder, "events").select(
        "event_id", F.nullif("event_type", F.lit("view")).alias("country"),
        F.nullif("props", F.lit('{"k": 1}')).alias("text"))
    return prepare.null_fill(holed, {"country": "Jordan", "text": ""})


def ensure_columns(spark, folder):
    holed = table(spark, folder, "documents").select(
        "doc_id", F.nullif("lang", F.lit("de")).alias("lang"),
        F.nullif("source", F.lit("src3")).alias("source"))
    return prepare.ensure_columns(holed, {"country": "Jordan", "source": "none"})


def project_first_label(spark, folder):
    labelled = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("text"), "source", F.col("lang").alias("country"),
        F.struct(F.regexp_extract_all("text", F.lit("[A-Z][a-z]{6,}"), F.lit(0)).alias("result"))
        .alias("class"), F.lit(None).cast("string").alias("timestamp"))
    return prepare.project_scored(labelled).select("text", "source", "country", "sentiment_label")


def stamp(spark, folder):
    return prepare.stamp(table(spark, folder, "events").select("event_id", "event_type"))


def stamp_checked(spark, folder):
    """How many rows are stamped, and whether all bear one time from after the call."""
    before = datetime.datetime.now(datetime.timezone.utc)
    stamped = stamp(spark, folder)
    return stamped.agg(
        F.count(F.lit(1)).alias("n"), F.count("processed_time").alias("n_stamped"),
        F.count_distinct("processed_time").alias("n_times"),
        (F.min("processed_time") >= F.lit(before)).alias("is_later"))


def event_time(spark, folder):
    texts = table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") == "error", "yesterday")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("timestamp"))
    return prepare.parse_event_time(texts).select(
        "event_id", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"))


# --- text and labels -------------------------------------------------------------------------


def documents(spark, folder):
    return table(spark, folder, "documents")


def tagged(spark, folder):
    """Documents as classified messages."""
    return documents(spark, folder).select(
        "doc_id", "text", F.col("lang").alias("country"), "source", "n_chars",
        polarity.lexicon_sentiment("text", given.GLAD, given.SAD).alias("sentiment"),
        polarity.topic_priority("text", given.TOPICS).alias("topic"),
        polarity.message_category("text", given.CATEGORIES, "other").alias("category"))


def lexicon_sentiment(spark, folder):
    return tagged(spark, folder).select("doc_id", "sentiment")


def topic_priority(spark, folder):
    return tagged(spark, folder).select("doc_id", "topic")


def topic_words(spark, folder):
    return documents(spark, folder).select("doc_id", polarity.topic_priority(
        "text", given.WORD_TOPICS, match="word").alias("topic"))


def topic_long(spark, folder):
    """The first of three topics of together some 5,000 keywords."""
    return documents(spark, folder).select(
        "doc_id", polarity.topic_priority("text", given.LONG_TOPICS).alias("topic"))


def message_category(spark, folder):
    return tagged(spark, folder).select("doc_id", "category")


def rating_polarity(spark, folder):
    stars = F.concat(F.col("n_chars") % 7, F.lit(" stars"))
    return documents(spark, folder).select(
        "doc_id", polarity.rating_polarity(stars).alias("sentiment"))


def normalize_text(spark, folder):
    return documents(spark, folder).select(
        "doc_id", text.normalize_text("text").alias("normalized"))


def keywords(spark, folder):
    every = text.keywords("text", given.STOPWORDS, limit=None)
    return documents(spark, folder).select("doc_id", every.alias("_all")).select(
        "doc_id",
        F.array_join(F.array_sort("_all"), " ").alias("keyword_set"),
        F.array_join(F.slice("_all", 1, 5), " ").alias("keywords"))


def token_counts(spark, folder):
    return documents(spark, folder).select(
        "doc_id", F.size(text.tokens("text")).cast("bigint").alias("n_tokens"))


def token_clean(spark, folder):
    return documents(spark, folder).select(
        "doc_id", F.array_join(text.clean_tokens("text"), " ").alias("normalized"))


def filter_negative(spark, folder):
    return prepare.filter_polarity(tagged(spark, folder)).select("doc_id", "country")


_RULES = prepare.MessageRules(categories=given.CATEGORIES, default_category="other",
                              stopwords=given.STOPWORDS, unspecified="unknown", engine="lexicon")


def enrich_message(spark, folder):
    messages = tagged(spark, folder).withColumn("gender", F.nullif("source", F.lit("src3")))
    return prepare.enrich_message(messages, _RULES, id="doc_id").select(
        "id", "sentiment", "category", "city", "age", "gender", "positive_words",
        "negative_words", F.array_join("keywords", " ").alias("keywords"),
        F.array_join("auto_categories", " ").alias("auto_categories"), "analysis_engine")


# --- model -----------------------------------------------------------------------------------


def quality_model(spark, folder):
    """The default classifier on all labelled documents, fitted once and then loaded."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("target"))
    examples = documents(spark, folder).select("doc_id", "text").join(labels, "doc_id")
    return stored_classifier(spark, f"{shared_folder(spark)}/models",
                             examples.select("text", "target"))


QUALITY_NAMES = ("negative", "positive")


def model_score(spark, folder):
    scored = classify.classify_text(documents(spark, folder).select("doc_id", "text"),
                                    quality_model(spark, folder), QUALITY_NAMES)
    return scored.select("doc_id", "sentiment_label", "confidence")


def model_score_checked(spark, folder):
    """Rows with a label and with a probability, and whether labels beat the commonest answer."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    scored = model_score(spark, folder).join(labels, "doc_id", "left").withColumn(
        "_right", ((F.col("sentiment_label") == QUALITY_NAMES[1]) == (F.col("quality") == 1))
        .cast("int"))
    bounded = F.col("confidence").between(0.5, 1)
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("sentiment_label").isin(*QUALITY_NAMES)).alias("n_labelled"),
        F.count_if(bounded).alias("n_bounded"),
        (F.avg("_right") > F.greatest(F.avg("quality"), 1 - F.avg("quality"))).alias("is_better"))


# --- lookups, dedup, recency, archive --------------------------------------------------------


def geo_lookup(spark, folder):
    messages = documents(spark, folder).select("doc_id", F.col("lang").alias("country"))
    return places.geo_lookup(messages, given.POINTS, default="en")


def geo_jitter(spark, folder):
    messages = documents(spark, folder).select("doc_id", F.col("lang").alias("country"))
    return places.geo_lookup(messages, given.POINTS, default="en", jitter=1.0, seed=7,
                             key="doc_id")


def events(spark, folder):
    return table(spark, folder, "events")


def dedup_new(spark, folder):
    """A full second delivery of the events against a store that holds the purchases."""
    every = events(spark, folder)
    stored = every.filter(F.col("event_type") == "purchase")
    return dedup.dedup_new(every.unionByName(every), stored)


def retain_latest(spark, folder):
    every = events(spark, folder)
    return dedup.retain_latest(every, every, 500)


def latest_n(spark, folder):
    stored = read_collection(spark, f"{folder}/events.parquet")
    return recent.latest_n(stored, 50)


def live_feed(spark, folder):
    return recent.live_feed(events(spark, folder), ["event_id", "ts", "event_type", "props"])


ARRIVED_LATER = "2024-01-25 00:00:00"


def archive_move(spark, folder):
    """Clicks are archived already; what came after the snapshot stays live."""
    live = events(spark, folder)
    archived = live.filter(F.col("event_type") == "click")
    snapshot = live.filter(F.col("ts") < F.lit(ARRIVED_LATER).cast("timestamp_ntz"))
    move = archive.archive_move(live, archived, snapshot)
    after = archived.unionByName(move.moved)
    return (
        after.select(F.lit("archive").alias("place"), "event_id", "event_type", "value")
        .unionByName(move.remaining.select(F.lit("live").alias("place"), "event_id", "event_type",
                                           "value"))
    )


def archive_batches(spark, folder):
    """Three stored batches, of which the two that a snapshot names go to the archive."""
    run = uuid.uuid4().hex
    live, archived = BatchTable(f"live_{run}"), BatchTable(f"archived_{run}")
    every = events(spark, folder)
    for number in range(3):
        live(every.filter(F.col("event_id") % 3 == number), number)
    archived(every.filter(F.col("event_id") < 0), 0)
    snapshot = [one for one in archive.live_batches(spark, live.table) if one[1] < 2]
    archive.archive_batches(spark, live.table, archived.table, snapshot)
    places = [spark.table(stored.table).select(F.lit(place).alias("place"), "event_id", "batch_id")
              for place, stored in (("live", live), ("archive", archived))]
    # written down, so that the tables need not outlive the call
    after = f"{scratch_folder(spark, 'batches')}/after"
    places[0].unionByName(places[1]).write.parquet(after)
    for stored in (live, archived):
        spark.sql(f"DROP TABLE {stored.table}")
    return spark.read.parquet(after)


def newest_exact(spark, folder):
    """The exact cut among crowded days, one message in ten without an id."""
    crowded = events(spark, folder).select(
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts"),
        F.when(F.col("event_id") % 10 != 0, F.col("event_id")).alias("event_id"))
    return recent.newest_first(recent.since_newest(crowded, 1000, refine_above=0), 1000)


def archive_by_file(spark, folder):
    """The same move between two folders of files, of which only the early ones are rewritten."""
    base = scratch_folder(spark, "by_file")
    every = events(spark, folder)
    every.repartitionByRange(8, "ts").write.parquet(f"{base}/live")
    every.filter(F.col("event_type") == "click").write.parquet(f"{base}/archive")
    archive_files.archive_by_file(
        spark, f"{base}/live", f"{base}/archive",
        every.filter(F.col("ts") < F.lit(ARRIVED_LATER).cast("timestamp_ntz")), every.schema, "run",
        archived=spark.read.schema(every.schema).parquet(f"{base}/archive"))
    return (
        spark.read.schema(every.schema).parquet(f"{base}/archive")
        .select(F.lit("archive").alias("place"), "event_id", "event_type", "value")
        .unionByName(spark.read.schema(every.schema).parquet(f"{base}/live").select(
            F.lit("live").alias("place"), "event_id", "event_type", "value"))
    )


_ARCHIVED_SQL = f"""
        SELECT 'archive' AS place, event_id, event_type, value FROM events
        WHERE event_type = 'click' OR ts < TIMESTAMP '{ARRIVED_LATER}'
        UNION ALL
        SELECT 'live' AS place, event_id, event_type, value FROM events
        WHERE ts >= TIMESTAMP '{ARRIVED_LATER}'"""

_WORD = r"(^|[^\p{L}\p{N}_])(%s)([^\p{L}\p{N}_]|$)"
_TOPIC_WORDS_SQL = "CASE " + " ".join(
    f"WHEN regexp_matches(lower(text), '{_WORD % '|'.join(lexicon.keywords)}') "
    f"THEN '{lexicon.label}'" for lexicon in given.WORD_TOPICS) + " ELSE 'General' END"

_EVENT_COLUMNS = "event_id, ts, user_id, event_type, value, props"

ENTRIES = {
    "json_parse": Entry(json_parse, f"""
        SELECT event_id, CASE WHEN json_valid(p) THEN
            TRY_CAST(json_extract_string(p, '$.k') AS INTEGER) END AS k
        FROM (SELECT event_id, {_PAYLOAD_SQL} AS p FROM events)"""),
    "json_rejects": Entry(json_rejects, f"""
        SELECT event_id, {_PAYLOAD_SQL} AS payload FROM events
        WHERE event_type IN ('error', 'signup')"""),
    "encode_json": Entry(encode, """
        SELECT CAST(json_object('event_id', event_id, 'event_type', event_type, 'value', value,
            'props', props) AS VARCHAR) AS payload FROM events"""),
    "null_fill": Entry(null_fill, """
        SELECT event_id, coalesce(nullif(event_type, 'view'), 'Jordan') AS country,
            coalesce(nullif(props, '{"k": 1}'), '') AS text FROM events"""),
    "ensure_columns": Entry(ensure_columns, """
        SELECT doc_id, coalesce(nullif(lang, 'de'), '') AS lang,
            coalesce(nullif(source, 'src3'), '') AS source, 'Jordan' AS country FROM documents"""),
    "project_first_label": Entry(project_first_label, """
        SELECT CAST(doc_id AS VARCHAR) AS text, source, lang AS country,
            regexp_extract_all(text, '[A-Z][a-z]{6,}')[1] AS sentiment_label FROM documents"""),
    "stamp": Entry(stamp),
    "stamp_checked": Entry(stamp_checked, """
        SELECT count(*) AS n, count(*) AS n_stamped, 1::BIGINT AS n_times, TRUE AS is_later
        FROM events"""),
    "event_time": Entry(event_time, """
        SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END
            AS event_ts FROM events"""),
    "lexicon_sentiment": Entry(lexicon_sentiment, f"""
        SELECT doc_id, {given.SENTIMENT_SQL} AS sentiment FROM documents"""),
    "topic_priority": Entry(topic_priority, f"""
        SELECT doc_id, {given.TOPIC_SQL} AS topic FROM documents"""),
    "topic_words": Entry(topic_words, f"""
        SELECT doc_id, {_TOPIC_WORDS_SQL} AS topic FROM documents"""),
    "topic_long": Entry(topic_long, f"""
        SELECT doc_id, CASE min(place) WHEN 0 THEN 'Work' WHEN 1 THEN 'Worry' WHEN 2 THEN 'Money'
            ELSE 'General' END AS topic
        FROM documents LEFT JOIN ({given.LONG_TOPICS_SQL}) ON contains(lower(text), word)
        GROUP BY doc_id"""),
    "message_category": Entry(message_category, f"""
        SELECT doc_id, {given.CATEGORY_SQL} AS category FROM documents"""),
    "rating_polarity": Entry(rating_polarity, """
        SELECT doc_id, CASE WHEN n_chars % 7 IN (4, 5) THEN 'positive'
            WHEN n_chars % 7 IN (1, 2) THEN 'negative' ELSE 'neutral' END AS sentiment
        FROM documents"""),
    "normalize_text": Entry(normalize_text, f"""
        SELECT doc_id, {given.NORMALIZED_SQL} AS normalized FROM documents"""),
    "keywords": Entry(keywords, f"""
        SELECT d.doc_id, coalesce(k.keyword_set, '') AS keyword_set,
            coalesce(k.keywords, '') AS keywords
        FROM documents d LEFT JOIN (
            SELECT doc_id, string_agg(word, ' ' ORDER BY word) AS keyword_set,
                array_to_string(list(word ORDER BY place)[1:5], ' ') AS keywords
            FROM ({given.WORDS_SQL}) GROUP BY doc_id) k USING (doc_id)"""),
    "token_counts": Entry(token_counts, f"""
        SELECT doc_id, CAST(len(regexp_extract_all(text, '{text.WORDS}')) AS BIGINT) AS n_tokens
        FROM documents"""),
    "token_clean": Entry(token_clean, f"""
        SELECT doc_id, array_to_string(list_filter(list_transform(
            regexp_extract_all(text, '{given.NON_SPACE_RE2}'),
            lambda t: regexp_replace(t, '{given.SYMBOLS_RE2}', '', 'g')), lambda t: t <> ''), ' ')
            AS normalized FROM documents"""),
    "filter_negative": Entry(filter_negative, f"""
        SELECT doc_id, lang AS country FROM documents
        WHERE {given.SENTIMENT_SQL} = 'negative'"""),
    "enrich_message": Entry(enrich_message, f"""
        SELECT CAST(doc_id AS VARCHAR) AS id, sentiment, category, city, 0 AS age, gender,
            CASE sentiment WHEN 'positive' THEN n ELSE 0 END AS positive_words,
            CASE sentiment WHEN 'negative' THEN n ELSE 0 END AS negative_words,
            keywords, category AS auto_categories, 'lexicon' AS analysis_engine
        FROM (
            SELECT doc_id, {given.SENTIMENT_SQL} AS sentiment, {given.CATEGORY_SQL} AS category,
                lang AS city, coalesce(nullif(source, 'src3'), 'unknown') AS gender,
                CAST(coalesce(k.n, 0) AS INTEGER) AS n, coalesce(k.keywords, '') AS keywords
            FROM documents LEFT JOIN (
                SELECT doc_id, least(count(*), 5) AS n,
                    array_to_string(list(word ORDER BY place)[1:5], ' ') AS keywords
                FROM ({given.WORDS_SQL}) GROUP BY doc_id) k USING (doc_id))"""),
    "model_score": Entry(model_score),
    "model_score_checked": Entry(model_score_checked, """
        SELECT count(*) AS n, count(*) AS n_labelled, count(*) AS n_bounded, TRUE AS is_better
        FROM documents"""),
    "geo_lookup": Entry(geo_lookup, """
        SELECT doc_id, lang AS country,
            CASE lang WHEN 'de' THEN 52.52::DOUBLE WHEN 'es' THEN 40.42::DOUBLE
                ELSE 51.5::DOUBLE END AS lat,
            CASE lang WHEN 'de' THEN 13.4::DOUBLE WHEN 'es' THEN -3.7::DOUBLE
                ELSE -0.25::DOUBLE END AS lon
        FROM documents"""),
    "geo_jitter": Entry(geo_jitter, """
        SELECT doc_id, country, round(lat + sqrt(-2 * ln(u)) * cos(2 * pi() * v), 6) AS lat,
            round(lon + sqrt(-2 * ln(u)) * sin(2 * pi() * v), 6) AS lon
        FROM (SELECT doc_id, lang AS country,
                CASE lang WHEN 'de' THEN 52.52::DOUBLE WHEN 'es' THEN 40.42::DOUBLE
                    ELSE 51.5::DOUBLE END AS lat,
                CASE lang WHEN 'de' THEN 13.4::DOUBLE WHEN 'es' THEN -3.7::DOUBLE
                    ELSE -0.25::DOUBLE END AS lon,
                (('0x' || substr(md5('7:' || doc_id), 1, 12))::BIGINT + 0.5::DOUBLE)
                    / 281474976710656::DOUBLE AS u,
                (('0x' || substr(md5('7:' || doc_id), 13, 12))::BIGINT + 0.5::DOUBLE)
                    / 281474976710656::DOUBLE AS v
            FROM documents)"""),
    "dedup_new": Entry(dedup_new, f"""
        SELECT DISTINCT {_EVENT_COLUMNS} FROM (SELECT * FROM events UNION ALL SELECT * FROM events)
        WHERE event_id NOT IN (SELECT event_id FROM events WHERE event_type = 'purchase')"""),
    "retain_latest": Entry(retain_latest, f"""
        SELECT {_EVENT_COLUMNS} FROM events ORDER BY ts DESC, event_id DESC LIMIT 500"""),
    "latest_n": Entry(latest_n, f"""
        SELECT {_EVENT_COLUMNS} FROM events ORDER BY ts DESC, event_id DESC LIMIT 50"""),
    "live_feed": Entry(live_feed, """
        SELECT event_id, ts, event_type, props FROM events
        ORDER BY ts DESC, event_id DESC LIMIT 5"""),
    "archive_move": Entry(archive_move, _ARCHIVED_SQL),
    "archive_by_file": Entry(archive_by_file, _ARCHIVED_SQL),
    "archive_batches": Entry(archive_batches, """
        SELECT CASE WHEN event_id % 3 < 2 THEN 'archive' ELSE 'live' END AS place, event_id,
            event_id % 3 AS batch_id FROM events"""),
    "newest_exact": Entry(newest_exact, """
        SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts,
            CASE WHEN event_id % 10 <> 0 THEN event_id END AS event_id
        FROM events ORDER BY 1 DESC, 2 DESC NULLS LAST LIMIT 1000"""),
}
