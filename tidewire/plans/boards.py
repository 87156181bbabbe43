"""The two sets of numbers that the dashboards show, as tables built on demand."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire import fixed_values as fixed
from tidewire.functions import polarity
from tidewire.operators import metrics, places, prepare, recent, series
from tidewire.operators.dedup import retain_latest

FEED_COLUMNS = ("text", "sentiment", "city", "gender", "age", "category", "analysis_engine")


@dataclass(frozen=True)
class SituationRules:
    topics: tuple = polarity.TOPICS
    default_topic: str = fixed.DEFAULT_TOPIC
    advice: tuple = fixed.ADVICE_RULES
    points: tuple = fixed.COUNTRY_POINTS
    default_country: str = fixed.DEFAULT_COUNTRY
    working_set: int | None = None  # all that is stored, or the newest so many
    pad: int = 0  # zeros before the first bucket of a series, as a board that starts shows them


@dataclass(frozen=True)
class Situation:
    """Topics, advice, density, series, alerts and forecasts of stored scored messages.

    Counts, advice and density are those of the working set; the series are counted over all
    that is stored, per event-time bucket.
    """

    stored: DataFrame
    rules: SituationRules = SituationRules()
    ts: str = "ts"
    id: str = "id"
    width: str = "1 hour"

    @property
    def names(self) -> list[str]:
        return [lexicon.label for lexicon in self.rules.topics]

    @cached_property
    def current(self) -> DataFrame:
        """The working set with polarity and topic."""
        newest = self.stored if self.rules.working_set is None else recent.latest_n(
            self.stored, self.rules.working_set, ts=self.ts, id=self.id)
        filled = prepare.ensure_columns(newest, {"country": self.rules.default_country})
        return filled.withColumns({
            "sentiment": polarity.rating_polarity("sentiment_label"),
            "topic": polarity.topic_priority("text", self.rules.topics, self.rules.default_topic),
        })

    @cached_property
    def counts(self) -> DataFrame:
        """Messages per topic and time bucket."""
        topic = polarity.topic_priority("text", self.rules.topics, self.rules.default_topic)
        tagged = self.stored.select(self.ts, topic.alias("topic")).filter(
            F.col("topic").isin(self.names))
        return series.bucket_counts(tagged, "topic", self.ts, self.width)

    def total(self) -> DataFrame:
        return metrics.total_count(self.stored)

    def topics(self) -> DataFrame:
        return metrics.topic_counts(self.current, self.names)

    def advice(self) -> DataFrame:
        by_topic = self.current.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
        return series.threshold_advice(by_topic, self.rules.advice)

    def density(self) -> DataFrame:
        return places.geo_density(self.current, self.rules.points,
                                  default=self.rules.default_country)

    def history(self) -> DataFrame:
        return series.series_history(self.counts, pad=self.rules.pad)

    def alerts(self) -> DataFrame:
        return series.spike_alerts(self.counts, pad=self.rules.pad)

    def forecast(self) -> DataFrame:
        return series.forecast_series(self.counts, pad=self.rules.pad)


@dataclass(frozen=True)
class MessageBoard:
    """Messages, numbers, distributions, flow and feed of the newest distinct messages."""

    stored: DataFrame
    rules: prepare.MessageRules = prepare.MessageRules()
    ts: str = "ts"
    id: str = "id"
    retained: int = fixed.RETAINED_MESSAGES

    @cached_property
    def kept(self) -> DataFrame:
        return retain_latest(self.stored, n=self.retained, ts=self.ts, id=self.id)

    def _enriched(self, df: DataFrame) -> DataFrame:
        return prepare.enrich_message(df, self.rules, id=self.id, timestamp=self.ts)

    @cached_property
    def messages(self) -> DataFrame:
        return self._enriched(self.kept)

    def kpis(self) -> DataFrame:
        return metrics.kpi_summary(self.messages)

    def sentiments(self) -> DataFrame:
        return metrics.distribution(self.messages)

    def categories(self) -> DataFrame:
        return metrics.cross_distribution(self.messages)

    def cities(self) -> DataFrame:
        return metrics.pivot_distribution(self.messages)

    def flow(self) -> DataFrame:
        return series.cumulative_flow(self.messages, "timestamp", "1 second")

    def feed(self) -> DataFrame:
        """The last few, newest first."""
        newest = recent.newest_first(self.kept, fixed.FEED_MESSAGES, ts=self.ts, id=self.id)
        return self._enriched(newest).select(*FEED_COLUMNS)
