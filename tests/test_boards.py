import datetime

from tidewire import schemas
from tidewire.plans import boards

START = datetime.datetime(2024, 1, 1)
TEXTS = [("شغل", "1 star", "Egypt"), ("قلق", "2 stars", None), ("سعر", "5 stars", "Oman"),
         ("صباح", "3 stars", "Kuwait")]


def stored(spark, n):
    rows = [(f"{TEXTS[i % 4][0]} {i}", "web", TEXTS[i % 4][2], TEXTS[i % 4][1], "", START
             + datetime.timedelta(minutes=10 * i)) for i in range(n)]
    return spark.createDataFrame(rows, schemas.SCORED_MESSAGE)


def test_situation_of_scored_messages(spark):
    board = boards.Situation(stored(spark, 80), ts="processed_at", id="text")
    assert board.total().first().total == 80
    assert tuple(board.topics().first()) == (20, 20, 20)
    assert {r.topic: r.level for r in board.advice().collect()} == {
        "Unemployment": "alert", "Anxiety": "alert"}
    # Anxiety has no country, so its messages lie at the default point
    assert {(r.lat_cell, r.lon_cell): r.n for r in board.density().collect()} == {
        (26, 30): 20, (31, 35): 20}
    assert {r.series for r in board.history().collect()} == {"Unemployment", "Anxiety", "Economy"}
    assert board.alerts().filter("is_spike").isEmpty()
    assert board.forecast().filter("kind = 'forecast'").count() == 30


def test_message_board_without_sentiment_or_person(spark):
    board = boards.MessageBoard(stored(spark, 30), ts="processed_at", id="text", retained=10)
    assert board.kpis().first().neutral_count == 10
    assert [r.text for r in board.feed().collect()] == [
        f"{TEXTS[i % 4][0]} {i}" for i in range(29, 24, -1)]
    assert board.flow().agg({"cumulative": "max"}).first()[0] == 10
    assert sum(r.n for r in board.sentiments().collect()) == 10
    assert sum(r.n for r in board.categories().collect()) == 10
    cities = {r.city: r.neutral for r in board.cities().collect()}
    assert sum(cities.values()) == 10 and "غير محدد" in cities
