from pyspark.sql import functions as F

from tidemark.streaming.groups import Group

SCHEMA = "id long, body string"


def put(spark, queue, ids, body="fine"):
    spark.createDataFrame([(i, body) for i in ids], SCHEMA).coalesce(1).write.mode("append").parquet(queue)


def poison(rows):
    return rows.withColumn("error", F.when(F.col("body") == "poison", "cannot be read").when((F.col("body") == "shaky") & (F.col("tries") < 1), "try again"))


def ids(rows):
    return sorted(r.id for r in rows.collect())


def test_groups_read_independently_and_poison_lands_after_its_tries(spark, tmp_path):
    queue, folder = str(tmp_path / "queue"), str(tmp_path / "groups")
    put(spark, queue, [1, 2])
    put(spark, queue, [3], "poison")
    put(spark, queue, [4], "shaky")
    a, b = (Group(spark, queue, SCHEMA, name, folder, poison) for name in "ab")
    a.run()
    assert ids(a.done()) == [1, 2] and ids(a.dead()) == [] and ids(b.done()) == []
    put(spark, queue, [5])
    a.run()  # redelivers what failed, with the new record
    assert ids(a.done()) == [1, 2, 4, 5] and {r.id: r.tries for r in a.done().collect()}[4] == 2
    assert a.retry() is False  # the third try of the poison
    assert [(r.id, r.tries, r.error) for r in a.dead().collect()] == [(3, 3, "cannot be read")]
    assert a.retry() is False and ids(a.dead()) == [3]
    b.run()
    while b.retry():
        pass
    assert ids(b.done()) == [1, 2, 4, 5] and ids(b.dead()) == [3]


def test_replay_of_dead_letters(spark, tmp_path):
    queue, folder = str(tmp_path / "queue"), str(tmp_path / "groups")
    put(spark, queue, [1, 2], "poison")
    group = Group(spark, queue, SCHEMA, "g", folder, poison, tries=1)
    group.replay()  # nothing yet
    group.run()
    assert ids(group.dead()) == [1, 2]
    group.replay()
    assert ids(group.dead()) == []
    healed = Group(spark, queue, SCHEMA, "g", folder, lambda rows: rows.withColumn("error", F.when(F.col("id") == 2, "still")), tries=2)
    assert healed.retry() is True and healed.retry() is False
    assert ids(healed.done()) == [1] and [(r.id, r.error, r.tries) for r in healed.dead().collect()] == [(2, "still", 2)]


def test_a_repeated_batch_replaces_what_it_wrote(spark, tmp_path):
    queue, folder = str(tmp_path / "queue"), str(tmp_path / "groups")
    put(spark, queue, [1])
    put(spark, queue, [2], "poison")
    group = Group(spark, queue, SCHEMA, "g", folder, poison)
    group.run()
    rows = spark.read.schema(SCHEMA).parquet(queue)
    group._batch(rows, 0)  # as after a crash before the offsets were committed
    assert ids(group.done()) == [1] and group.retry() is True
