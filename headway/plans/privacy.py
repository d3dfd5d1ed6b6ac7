"""Personal-data export, rectification and erasure, for any number of persons at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions import clock

ACCOUNT_FIELDS = ["id", "email", "first_name", "last_name", "phone"]
RECTIFIABLE = ["email", "first_name", "last_name", "phone"]


def _account(prefix: str = "") -> Column:
    fields = [F.col(prefix + c).alias(c) for c in ACCOUNT_FIELDS]
    return F.struct(*fields, clock.iso_stamp(prefix + "created_at").alias("created_at"))


def _json(record: Column) -> Column:
    """JSON with unknown values shown as null."""
    return F.to_json(record, {"ignoreNullFields": "false"})


def person_export(users: DataFrame, subscriptions: DataFrame, notifications: DataFrame) -> DataFrame:
    """All data of every person as ordered JSON records, without the password hash.

    One record per account, subscription and notification: (user_id, subscription_id,
    notification_id) orders them so that each record follows its parent. A person with
    very many rows stays many rows; ``person_documents`` joins them to documents.
    """
    subs = subscriptions.withColumn("created_at", clock.iso_stamp("created_at"))
    notes = notifications.withColumn("created_at", clock.iso_stamp("created_at")).withColumn(
        "notify_date", clock.iso_date("notify_date")
    )
    none = F.lit(None).cast("long")
    accounts = users.select(
        F.col("id").alias("user_id"),
        none.alias("subscription_id"),
        none.alias("notification_id"),
        F.lit("account").alias("record"),
        _json(_account()).alias("content"),
    )
    owned = subs.select(
        "user_id",
        F.col("id").alias("subscription_id"),
        none.alias("notification_id"),
        F.lit("subscription").alias("record"),
        _json(F.struct(*subs.columns)).alias("content"),
    )
    owner = subscriptions.select(F.col("id").alias("subscription_id"), "user_id")
    sent = notes.join(owner, "subscription_id").select(
        "user_id",
        "subscription_id",
        F.col("id").alias("notification_id"),
        F.lit("notification").alias("record"),
        _json(F.struct(*notes.columns)).alias("content"),
    )
    return accounts.unionByName(owned).unionByName(sent)


def person_documents(records: DataFrame) -> DataFrame:
    """The records of person_export with the piece of JSON that each is in its person's document.

    A person's pieces, in the order of (subscription_id, notification_id) with nulls first, make one nested
    document: account, subscriptions by id, each with its notifications by id. A piece
    knows from the records beside it which brackets it opens and closes, so no document is
    ever held whole, however many records a person has.
    """
    order = Window.partitionBy("user_id").orderBy(F.col("subscription_id").asc_nulls_first(), F.col("notification_id").asc_nulls_first())
    before, after = F.lag("record").over(order), F.lead("record").over(order)
    own, content = F.col("record"), F.col("content")
    opened = F.when(before.isNull(), F.when(own == "account", F.lit('{"account":')).otherwise('{"account":null,"subscriptions":['))
    opened = opened.when((own == "subscription") & (before != "account"), F.lit("]},")).when((own == "notification") & (before == "notification"), F.lit(","))
    body = (
        F.when(own == "account", F.concat(content, F.lit(',"subscriptions":[')))
        .when(own == "subscription", F.concat(F.expr("left(content, length(content) - 1)"), F.lit(',"notifications":[')))
        .otherwise(content)
    )
    closed = F.when(after.isNull(), F.when(own == "account", F.lit("]}")).otherwise("]}]}")).otherwise("")
    piece = F.concat(F.coalesce(opened, F.lit("")), body, closed)
    return records.select("user_id", "subscription_id", "notification_id", piece.alias("piece"), before.isNull().alias("first"))


def write_documents(records: DataFrame, folder: str) -> None:
    """Every person's document in the folder's text files, which are JSON text sequences (RFC 7464).

    A document begins with a record separator and has a line for each piece. A person's records
    are sorted within one partition and pass through it one by one.
    """
    pieces = person_documents(records).sortWithinPartitions("user_id", F.col("subscription_id").asc_nulls_first(), F.col("notification_id").asc_nulls_first())
    line = F.when(F.col("first"), F.concat(F.lit("\x1e"), "piece")).otherwise(F.col("piece"))
    pieces.select(line.alias("value")).write.text(folder)


def rectification_outcomes(users: DataFrame, updates: DataFrame) -> DataFrame:
    """Each requested update with its cleaned values and the reason it is refused, if any.

    ``updates`` has id and any of the rectifiable fields, NULL meaning "not given". Given
    values are trimmed, e-mails lowered. Refused: unknown person, nothing given, a blank
    value, an e-mail another account has, or one that an update with a lesser id also asks for.
    """
    fields = [c for c in RECTIFIABLE if c in updates.columns]
    cleaned = updates.select("id", *[(F.lower(F.trim(c)) if c == "email" else F.trim(c)).alias(c) for c in fields])
    blank = F.lit(False)
    given = F.lit(False)
    for c in fields:
        blank = blank | F.coalesce(F.col(c) == "", F.lit(False))
        given = given | F.col(c).isNotNull()
    known = users.select("id").withColumn("_known", F.lit(True))
    out = cleaned.join(known, "id", "left").withColumns({"_blank": blank, "_given": given})
    reason = (
        F.when(F.col("_known").isNull(), "unknown person")
        .when(~F.col("_given"), "nothing to change")
        .when(F.col("_blank"), "blank value")
    )
    if "email" in fields:
        # Per wanted e-mail: its present holder and the first asker, one row each.
        holders = users.groupBy(F.lower("email").alias("email")).agg(F.min("id").alias("_holder"))
        askers = cleaned.where(F.col("email").isNotNull()).groupBy("email").agg(F.min("id").alias("_first"))
        out = out.join(holders, "email", "left").join(askers, "email", "left")
        taken = (F.col("_holder") != F.col("id")) | (F.col("_first") < F.col("id"))
        reason = reason.when(F.coalesce(taken, F.lit(False)), "email already used")
    return out.select("id", *fields, reason.alias("refused"))


def person_rectify(users: DataFrame, updates: DataFrame) -> DataFrame:
    """Users with all accepted updates applied."""
    outcomes = rectification_outcomes(users, updates).where(F.col("refused").isNull())
    fields = [c for c in RECTIFIABLE if c in outcomes.columns]
    accepted = outcomes.select("id", *[F.col(c).alias(f"_new_{c}") for c in fields])
    joined = users.join(accepted, "id", "left")
    return joined.select(
        *[F.coalesce(f"_new_{c}", c).alias(c) if c in fields else F.col(c) for c in users.columns]
    )


def person_erase(
    users: DataFrame, subscriptions: DataFrame, notifications: DataFrame, persons: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(users, subscriptions, notifications, counts) without the given persons, cascading.

    ``persons`` holds the ids to erase; counts has one row per erased account.
    """
    gone = users.join(persons.select("id").distinct(), "id", "left_semi").select(F.col("id").alias("user_id"))
    gone_subs = subscriptions.join(gone, "user_id", "left_semi").select(F.col("id").alias("subscription_id"), "user_id")
    notes = notifications.groupBy("subscription_id").agg(F.count("*").alias("n"))
    counted = (
        gone_subs.join(notes, "subscription_id", "left")
        .groupBy("user_id")
        .agg(F.count("*").alias("subscriptions"), F.sum(F.coalesce("n", F.lit(0))).alias("notifications"))
    )
    counts = gone.join(counted, "user_id", "left").select(
        "user_id",
        F.lit(1).alias("accounts"),
        F.coalesce("subscriptions", F.lit(0)).alias("subscriptions"),
        F.coalesce("notifications", F.lit(0)).alias("notifications"),
    )
    kept_users = users.join(gone.withColumnRenamed("user_id", "id"), "id", "left_anti")
    kept_subs = subscriptions.join(gone, "user_id", "left_anti")
    kept_notes = notifications.join(gone_subs, "subscription_id", "left_anti")
    return kept_users, kept_subs, kept_notes, counts
