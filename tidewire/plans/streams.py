"""The three streaming jobs: from payloads to the rows that are stored, and how they are run."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewire import fixed_values as fixed
from tidewire import schemas
from tidewire.functions.polarity import lexicon_sentiment
from tidewire.operators.classify import classify_text
from tidewire.operators.prepare import accepted, json_parse, null_fill, rejected, stamp
from tidewire.sources.messages import KafkaTopic, carried, decode
from tidewire.sources.sinks import BatchWriter
from tidewire.streaming.queries import fan_out, for_each_batch


def social_source(servers: str, **options: str) -> KafkaTopic:
    return KafkaTopic(servers, fixed.SOCIAL_TOPIC, "latest", options)


def survey_source(servers: str, **options: str) -> KafkaTopic:
    return KafkaTopic(servers, fixed.SURVEY_TOPIC, "latest", options)


def employment_source(servers: str, **options: str) -> KafkaTopic:
    return KafkaTopic(servers, fixed.EMPLOYMENT_TOPIC, "earliest", options)


def scored_messages(messages: DataFrame, model: PipelineModel, labels: Sequence[str],
                    rejects: str | None = None) -> DataFrame:
    """Social messages with the model's label, in the stored form, behind their identity if the
    messages have one."""
    kept = carried(messages)
    parsed = null_fill(json_parse(decode(messages), schemas.SOCIAL_MESSAGE, keep=kept,
                                  rejects=rejects))
    scored = classify_text(parsed, model, labels)
    return stamp(scored.select(*kept, "text", "source", "country", "sentiment_label", "timestamp",
                               *[rejects] * bool(rejects)), "processed_at")


def tagged_surveys(messages: DataFrame, positive: Sequence[str] = fixed.POSITIVE_WORDS,
                   negative: Sequence[str] = fixed.NEGATIVE_WORDS,
                   rejects: str | None = None) -> DataFrame:
    """Survey messages with their lexicon sentiment."""
    parsed = json_parse(decode(messages), schemas.SURVEY_MESSAGE, keep=carried(messages),
                        rejects=rejects)
    tagged = parsed.withColumn("sentiment", lexicon_sentiment(F.col("text"), positive, negative))
    return stamp(tagged)


def indicators(messages: DataFrame, rejects: str | None = None) -> DataFrame:
    """Employment indicators with their map of sectors."""
    return json_parse(decode(messages), schemas.EMPLOYMENT_INDICATOR, keep=carried(messages),
                      rejects=rejects)


#: Column of the payloads that did not fit their schema.
PAYLOAD = "rejected_payload"


def _beside_rejects(writers: Sequence[BatchWriter], dead: BatchWriter) -> list[BatchWriter]:
    """Writers of what fitted its schema, and one of the payloads that did not."""
    def part(write: BatchWriter, of: Callable[[DataFrame], DataFrame]) -> BatchWriter:
        def save(batch: DataFrame, batch_id: int) -> None:
            rows = of(batch)
            if not rows.isEmpty():
                write(rows, batch_id)
        return save

    def payloads(batch: DataFrame) -> DataFrame:
        return rejected(batch, PAYLOAD, keep=carried(batch))

    return [*(part(write, lambda batch: accepted(batch, PAYLOAD)) for write in writers),
            part(dead, payloads)]


def run_social(messages: DataFrame, model: PipelineModel, labels: Sequence[str],
               writers: Sequence[BatchWriter], checkpoint: str,
               trigger: Mapping | None = None, dead: BatchWriter | None = None) -> StreamingQuery:
    """Score social messages once per batch and hand them to every writer (store, console).

    In this job and the next two, ``dead`` takes the payloads that do not fit their schema, with
    the messages' identity; they are then not stored as rows of NULLs.
    """
    if dead is None:
        return fan_out(scored_messages(messages, model, labels), writers, checkpoint,
                       name="social", trigger=trigger)
    return fan_out(scored_messages(messages, model, labels, PAYLOAD),
                   _beside_rejects(writers, dead), checkpoint, name="social", trigger=trigger)


def run_surveys(messages: DataFrame, write: BatchWriter, checkpoint: str,
                positive: Sequence[str] = fixed.POSITIVE_WORDS,
                negative: Sequence[str] = fixed.NEGATIVE_WORDS,
                trigger: Mapping | None = None, dead: BatchWriter | None = None) -> StreamingQuery:
    if dead is None:
        return for_each_batch(tagged_surveys(messages, positive, negative), write, checkpoint,
                              name="surveys", trigger=trigger)
    return fan_out(tagged_surveys(messages, positive, negative, PAYLOAD),
                   _beside_rejects([write], dead), checkpoint, name="surveys", trigger=trigger)


def run_indicators(messages: DataFrame, write: BatchWriter, checkpoint: str,
                   trigger: Mapping | None = None,
                   dead: BatchWriter | None = None) -> StreamingQuery:
    if dead is None:
        return for_each_batch(indicators(messages), write, checkpoint, name="indicators",
                              trigger=trigger)
    return fan_out(indicators(messages, PAYLOAD), _beside_rejects([write], dead), checkpoint,
                   name="indicators", trigger=trigger)
