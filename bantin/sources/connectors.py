"""Option sets for outside systems. Their connectors are separate JARs the cluster provides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

KAFKA = "kafka"
MONGODB = "mongodb"
ELASTICSEARCH = "org.elasticsearch.spark.sql"


def kafka_source_options(topics: str | list[str], servers: str, starting: str | None = "earliest") -> dict[str, str]:
    """Subscribe to one or more topics; `starting=None` leaves the source's own default (latest)."""
    names = [topics] if isinstance(topics, str) else list(topics)
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(names),
        "failOnDataLoss": "false",
    }
    if starting is not None:
        options["startingOffsets"] = starting
    return options


def kafka_sink_options(servers: str, topic: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers}
    return options if topic is None else {**options, "topic": topic}


def mongodb_options(uri: str, database: str, collection: str) -> dict[str, str]:
    return {
        "spark.mongodb.connection.uri": uri,
        "spark.mongodb.database": database,
        "spark.mongodb.collection": collection,
    }


def mongodb_upsert_options(uri: str, database: str, collection: str, key: list[str]) -> dict[str, str]:
    """Write by key: the stored document is updated, or inserted when absent."""
    return {
        **mongodb_options(uri, database, collection),
        "operationType": "update",
        "upsertDocument": "true",
        "idFieldList": ",".join(key),
    }


def elasticsearch_options(
    nodes: str,
    index: str,
    port: int = 9200,
    user: str | None = None,
    password: str | None = None,
    upsert_by: str | None = None,
    allow_self_signed: bool = False,
) -> dict[str, str]:
    """Index writes; `upsert_by` names the id column and turns appends into upserts."""
    options = {
        "es.nodes": nodes,
        "es.port": str(port),
        "es.resource": index,
        "es.net.ssl": "true",
        "es.nodes.resolve.hostname": "false",
        "es.net.ssl.cert.allow.self.signed": str(allow_self_signed).lower(),
        "es.nodes.wan.only": "true",
        "es.nodes.discovery": "false",
    }
    if user is not None:
        options["es.net.http.auth.user"] = user
        options["es.net.http.auth.pass"] = password or ""
    if upsert_by is not None:
        options["es.mapping.id"] = upsert_by
        options["es.write.operation"] = "upsert"
    return options


def read_kafka_stream(spark: SparkSession, topics, servers: str, starting: str | None = "earliest") -> DataFrame:
    return spark.readStream.format(KAFKA).options(**kafka_source_options(topics, servers, starting)).load()


def read_mongodb(spark: SparkSession, uri: str, database: str, collection: str, schema=None) -> DataFrame:
    reader = spark.read.format(MONGODB).options(**mongodb_options(uri, database, collection))
    return (reader.schema(schema) if schema is not None else reader).load()
