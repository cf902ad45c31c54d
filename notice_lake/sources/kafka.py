"""Kafka source: connection options and the read, as stream or batch.

The connector jar is not part of PySpark; submit with the
``spark-sql-kafka-0-10`` package to use ``read_topic``. Everything downstream
takes any DataFrame with the connector's columns.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Class names of the Kafka client's OAuth login.
OAUTH_MODULE = "org.apache.kafka.common.security.oauthbearer.OAuthBearerLoginModule"
OAUTH_HANDLER = "org.apache.kafka.common.security.oauthbearer.OAuthBearerLoginCallbackHandler"
_TOPIC_CHOICES = ("subscribe", "subscribePattern", "assign")


def oauth_options(
    client_id: str, client_secret: str, token_url: str, *, class_prefix: str = ""
) -> dict[str, str]:
    """SASL_SSL with OAUTHBEARER client credentials.

    ``class_prefix`` is for runtimes that relocate the Kafka client's packages.
    """
    for name, value in (("client_id", client_id), ("client_secret", client_secret)):
        if '"' in value or "\\" in value:
            raise ValueError(f"{name} cannot be quoted into the login configuration")
    return {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "OAUTHBEARER",
        "kafka.sasl.jaas.config": (
            f"{class_prefix}{OAUTH_MODULE} required"
            f' clientId="{client_id}" clientSecret="{client_secret}";'
        ),
        "kafka.sasl.login.callback.handler.class": f"{class_prefix}{OAUTH_HANDLER}",
        "kafka.sasl.oauthbearer.token.endpoint.url": token_url,
    }


def kafka_options(
    bootstrap_servers: str,
    *,
    subscribe: str | None = None,
    subscribe_pattern: str | None = None,
    assign: str | None = None,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    security: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of one Kafka read; exactly one way of choosing topics is required.

    ``starting_offsets`` matters to a new checkpoint only. With
    ``fail_on_data_loss=False`` lost offsets are skipped, so watch ``offset_gaps``.
    ``min_partitions`` splits a hot topic partition's offset range over more tasks.
    """
    choices = dict(zip(_TOPIC_CHOICES, (subscribe, subscribe_pattern, assign)))
    chosen = {name: value for name, value in choices.items() if value}
    if len(chosen) != 1:
        raise ValueError(f"choose topics by exactly one of {', '.join(_TOPIC_CHOICES)}")
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        **chosen,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        **(security or {}),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_topic(
    spark: SparkSession, options: Mapping[str, str], *, streaming: bool = True
) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**options).load()
