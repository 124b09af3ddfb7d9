"""Cloud run resources (service, job, execution JSON) flattened to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.functions.scalars import condition_state, condition_type, parse_resource_name

CONTAINER = (
    "STRUCT<image: STRING, args: ARRAY<STRING>, command: ARRAY<STRING>, "
    "env: ARRAY<STRUCT<name: STRING, value: STRING>>, resources: STRUCT<limits: MAP<STRING, STRING>>, "
    "volumeMounts: ARRAY<STRUCT<name: STRING, mountPath: STRING>>>"
)
VOLUME = "STRUCT<name: STRING, cloudSqlInstance: STRUCT<instances: ARRAY<STRING>>>"
TASK = f"timeout: STRING, serviceAccount: STRING, containers: ARRAY<{CONTAINER}>, volumes: ARRAY<{VOLUME}>"
SERVICE = (f"name STRING, uri STRING, template STRUCT<{TASK}, "
           "scaling: STRUCT<maxInstanceCount: INT, minInstanceCount: INT>>")
JOB = ("name STRING, labels MAP<STRING, STRING>, createTime TIMESTAMP, updateTime TIMESTAMP, "
       f"template STRUCT<parallelism: INT, taskCount: INT, template: STRUCT<{TASK}, maxRetries: INT>>")
EXECUTION = ("name STRING, generation BIGINT, startTime TIMESTAMP, updateTime TIMESTAMP, completionTime TIMESTAMP, "
             f"template STRUCT<{TASK}>, "
             "conditions ARRAY<STRUCT<type: STRING, state: STRING, lastTransitionTime: TIMESTAMP>>")


def env_map(env: Column) -> Column:
    """Name/value pairs as a map: missing parts are '', the last of equal names wins."""
    named = F.transform(F.coalesce(env, F.array()), lambda e: F.struct(
        F.coalesce(e["name"], F.lit("")).alias("name"), F.coalesce(e["value"], F.lit("")).alias("value")))
    # keep an entry only when no later one has its name
    last = F.filter(named, lambda e, i: ~F.exists(
        F.slice(named, i + 2, F.size(named)), lambda later: later["name"] == e["name"]))
    return F.map_from_entries(last)


def timeout_seconds(text: Column) -> Column:
    """Whole seconds of a duration text such as `600s` or `1.5s`."""
    return F.regexp_extract(text, r"^(-?[0-9]+)(?:\.[0-9]+)?s$", 1).try_cast("bigint")


def _list(items: Column, empty: str) -> Column:
    return F.coalesce(items, F.array().cast(empty))


def containers(items: Column) -> Column:
    return F.transform(F.coalesce(items, F.from_json(F.lit("[]"), f"ARRAY<{CONTAINER}>")), lambda c: F.struct(
        c["image"].alias("image"), _list(c["args"], "array<string>").alias("args"),
        _list(c["command"], "array<string>").alias("command"), env_map(c["env"]).alias("env"),
        F.coalesce(c["resources"]["limits"], F.create_map().cast("map<string,string>")).alias("resources"),
        F.transform(F.coalesce(c["volumeMounts"], F.array().cast("array<struct<name:string,mountPath:string>>")),
                    lambda m: F.struct(m["name"].alias("name"), m["mountPath"].alias("mount_path")))
        .alias("volume_mounts")))


def volumes(items: Column) -> Column:
    """Volumes with the first attached database instance, null when there is none."""
    return F.transform(F.coalesce(items, F.from_json(F.lit("[]"), f"ARRAY<{VOLUME}>")), lambda v: F.struct(
        v["name"].alias("name"),
        F.get(v["cloudSqlInstance"]["instances"], F.lit(0)).alias("cloud_sql_instance")))


def _flatten(resources: DataFrame, body: str, schema: str, kind: str, task_of, columns, keep) -> DataFrame:
    keep = keep or []
    parsed = resources.select(*keep, F.from_json(F.col(body), schema).alias("r"))
    r = F.col("r")
    task = task_of(r)
    error = F.when(r["template"].isNull(), F.lit("template does not exist")).when(
        task.isNull(), F.lit("task template does not exist"))
    return parsed.select(
        *keep, parse_resource_name(r["name"], kind).alias("name"), *columns(r),
        timeout_seconds(task["timeout"]).alias("timeout"), task["serviceAccount"].alias("service_account"),
        containers(task["containers"]).alias("containers"), volumes(task["volumes"]).alias("volumes"),
        error.alias("error"))


def flatten_services(resources: DataFrame, body: str, keep: list[str] | None = None) -> DataFrame:
    return _flatten(resources, body, SERVICE, "service", lambda r: r["template"], lambda r: [
        r["template"]["scaling"]["maxInstanceCount"].alias("max_instance_count"),
        r["template"]["scaling"]["minInstanceCount"].alias("min_instance_count"),
        r["uri"].alias("uri")], keep)


def flatten_jobs(resources: DataFrame, body: str, keep: list[str] | None = None) -> DataFrame:
    return _flatten(resources, body, JOB, "job", lambda r: r["template"]["template"], lambda r: [
        F.coalesce(r["labels"], F.create_map().cast("map<string,string>")).alias("labels"),
        r["template"]["parallelism"].alias("parallelism"), r["template"]["taskCount"].alias("task_count"),
        r["template"]["template"]["maxRetries"].alias("max_retries"),
        r["createTime"].alias("create_time"), r["updateTime"].alias("update_time")], keep)


def flatten_executions(resources: DataFrame, body: str, keep: list[str] | None = None) -> DataFrame:
    return _flatten(resources, body, EXECUTION, "execution", lambda r: r["template"], lambda r: [
        r["generation"].alias("generation"), r["startTime"].alias("start_time"),
        r["updateTime"].alias("update_time"), r["completionTime"].alias("completion_time"),
        F.transform(
            F.coalesce(r["conditions"],
                       F.array().cast("array<struct<type:string,state:string,lastTransitionTime:timestamp>>")),
            lambda c: F.struct(condition_type(c["type"]).alias("type"), condition_state(c["state"]).alias("state"),
                               c["lastTransitionTime"].alias("last_transition_time"))).alias("conditions")],
        keep).drop("volumes")


def container_rows(flat: DataFrame, *keep: str) -> DataFrame:
    """One row per container; resources without containers keep a row."""
    return flat.select(*keep, F.explode_outer("containers").alias("c")).select(*keep, "c.*")
