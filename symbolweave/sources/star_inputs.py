"""Manifests, schema declarations, language-server results and listings from order tables.

They feed the ingest operators with input whose size grows with the given tables.
"""

from pyspark.sql import functions as F

from .. import schema
from ..plans.sizing import dealt, never_broadcast
from .starschema import repository, table

WORKLOADS = ("Deployment", "CronJob", "Pod", "RoleBinding", "Ingress", "StatefulSet")


def _name(prefix, key):
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def _namespace(key):
    """Every third object names no namespace."""
    return F.when(F.col(key) % 3 > 0, F.concat(F.lit("ns-"), (F.col(key) % 3).cast("string")))


def k8s_objects(spark, folder):
    """Secrets from parts, service accounts from customers, workloads from orders."""
    meta = lambda name, ns: F.struct(name.alias("name"), ns.alias("namespace"))
    secrets = table(spark, folder, "part").select(
        F.concat(F.lit("repo-"), (F.col("p_partkey") % 5).cast("string")).alias("source"), F.lit("secrets").alias("root"),
        F.col("p_partkey").alias("object_index"),
        F.to_json(F.struct(
            F.lit("Secret").alias("kind"), meta(_name("secret-", "p_partkey"), _namespace("p_size")).alias("metadata"),
        )).alias("manifest"),
    )
    accounts = table(spark, folder, "customer").select(
        F.concat(F.lit("repo-"), (F.col("c_custkey") % 5).cast("string")).alias("source"), F.lit("").alias("root"),
        F.col("c_custkey").alias("object_index"),
        F.to_json(F.struct(
            F.lit("ServiceAccount").alias("kind"),
            meta(_name("account-", "c_custkey"), _namespace("c_custkey")).alias("metadata"),
        )).alias("manifest"),
    )
    used = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", _name("secret-", "l_partkey").alias("secret"),
    ).groupBy("o_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "secret"))).alias("used"),
    )
    orders = table(spark, folder, "orders").join(never_broadcast(used), "o_orderkey", "left")
    of = lambda part: F.filter(F.coalesce("used", F.array().cast("array<struct<l_linenumber:int,secret:string>>")),
                               lambda u: u["l_linenumber"] % 3 == part)
    account = _name("account-", "o_custkey")
    pod = F.struct(
        F.when(F.col("o_custkey") % 2 == 0, account).alias("serviceAccountName"), account.alias("serviceAccount"),
        F.transform(of(0), lambda u: F.struct(F.struct(u["secret"].alias("secretName")).alias("secret"))).alias("volumes"),
        F.array(F.struct(F.transform(
            of(1), lambda u: F.struct(F.struct(u["secret"].alias("name")).alias("secretRef")),
        ).alias("envFrom"))).alias("containers"),
        F.array(F.struct(F.transform(
            of(2), lambda u: F.struct(F.struct(F.struct(u["secret"].alias("name")).alias("secretKeyRef")).alias("valueFrom")),
        ).alias("env"))).alias("initContainers"),
    )
    kind = F.element_at(F.array(*[F.lit(k) for k in WORKLOADS]), (F.col("o_orderkey") % 6 + 1).cast("int"))
    metadata = F.when(
        ~F.startswith("o_orderpriority", F.lit("5")), meta(_name("app-", "o_orderkey"), _namespace("o_custkey")),
    )
    empty = lambda k: F.col("kind") == k
    template = F.struct(pod.alias("spec"))
    spec = {
        "template": F.when(F.col("kind").isin("Deployment", "StatefulSet"), template),
        "jobTemplate": F.when(empty("CronJob"), F.struct(F.struct(template.alias("template")).alias("spec"))),
        "serviceAccountName": F.when(empty("Pod"), pod["serviceAccountName"]),
        "serviceAccount": F.when(empty("Pod"), pod["serviceAccount"]),
        "volumes": F.when(empty("Pod"), pod["volumes"]),
        "containers": F.when(empty("Pod"), pod["containers"]),
        "initContainers": F.when(empty("Pod"), pod["initContainers"]),
    }
    staged = orders.withColumn("kind", kind)
    manifest = F.to_json(F.struct(
        "kind", metadata.alias("metadata"),
        F.struct(*[v.alias(k) for k, v in spec.items()]).alias("spec"),
        F.when(empty("RoleBinding"), F.array(F.struct(
            F.lit("ServiceAccount").alias("kind"), account.alias("name"), F.lit("").alias("namespace"),
        ))).alias("subjects"),
    ))
    workloads = staged.select(
        repository().alias("source"), F.concat(F.lit("deploy/batch-"), F.floor(F.col("o_orderkey") / 100).cast("string")).alias("root"),
        F.col("o_orderkey").alias("object_index"), manifest.alias("manifest"),
    )
    return secrets.unionByName(accounts).unionByName(workloads)


ACCESS_KINDS = (
    "RoleBinding", "RoleBinding", "ClusterRoleBinding", "ClusterRoleBinding", "Ingress", "DaemonSet", "ReplicaSet", "Job",
)


def access_objects(spark, folder):
    """Bindings, ingresses and pod templates from orders: every branch of the reference rules.

    Roles come with a kind, without one, or not at all; services of an ingress come from its line items, and every other
    ingress has a default one.
    """
    key = F.col("o_orderkey")
    account = _name("account-", "o_custkey")
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", _name("service-", "l_suppkey").alias("name")))).alias("services"),
    )
    orders = table(spark, folder, "orders").join(never_broadcast(lines), "o_orderkey", "left")
    nth = (key % 8).cast("int")
    kind = F.element_at(F.array(*[F.lit(k) for k in ACCESS_KINDS]), nth + 1)
    only = lambda condition, value: F.when(condition, value)
    role = F.struct(
        F.when(nth.isin(1, 2), "ClusterRole").when(nth == 3, "").alias("kind"), _name("role-", "o_custkey").alias("name"),
    )
    backend = lambda s: F.struct(F.struct(F.struct(s["name"].alias("name")).alias("service")).alias("backend"))
    rules = F.array(
        F.struct(F.struct(F.transform(F.col("services"), backend).alias("paths")).alias("http")),
        F.struct(F.lit(None).cast("struct<paths:array<struct<backend:struct<service:struct<name:string>>>>>").alias("http")),
    )
    spec = F.struct(
        only(nth >= 5, F.struct(F.struct(account.alias("serviceAccountName")).alias("spec"))).alias("template"),
        only((nth == 4) & F.col("services").isNotNull(), rules).alias("rules"),
        only((nth == 4) & (key % 16 == 4), F.struct(F.struct(F.lit("fallback").alias("name")).alias("service"))).alias("defaultBackend"),
    )
    manifest = F.to_json(F.struct(
        kind.alias("kind"), F.struct(_name("access-", "o_orderkey").alias("name"), _namespace("o_custkey").alias("namespace")).alias("metadata"),
        only((nth < 4) & (key % 24 != 0), role).alias("roleRef"), spec.alias("spec"),
    ))
    return orders.select(repository().alias("source"), F.lit("access").alias("root"), key.alias("object_index"), manifest.alias("manifest"))


def enum_tables(edges):
    """Schema files with enums beside their messages, which fields of the messages name."""
    lines = edges.filter("leads_line").select("source", "doc_id", "l_linenumber")
    file = F.concat(F.lit("enums/order_"), F.col("doc_id").cast("string"), F.lit(".proto"))
    n = (F.col("l_linenumber") - 1).cast("int")
    named = lambda prefix: F.concat(F.lit(prefix), F.col("l_linenumber").cast("string"))

    def decl(path, kind, name, field_type=None, type_name=None):
        none = F.lit(None).cast("string")
        return F.struct(
            F.array(*[F.lit(p) if isinstance(p, int) else p for p in path]).alias("path"), F.lit(kind).alias("kind"),
            name.alias("name"), F.lit(field_type).cast("int").alias("field_type"),
            (none if type_name is None else type_name).alias("type_name"), none.alias("input_type"), none.alias("output_type"),
        )

    declarations = lines.select("source", file.alias("file"), F.lit(None).cast("string").alias("package"), F.explode(F.array(
        decl([5, n], "enum", named("Mode")), decl([5, n, 2, 0], "value", F.lit("ON")), decl([4, n], "message", named("Line")),
        decl([4, n, 2, 0], "field", F.lit("mode"), 14, named(".Mode")),
    )).alias("d")).select("source", "file", "package", "d.*")
    line = F.element_at("path", 2) * 20 + F.element_at("path", 1) * 3 + F.size("path")
    spans = declarations.select("source", "file", "path", F.explode(F.array(F.lit(1), F.lit(6))).alias("step")).select(
        "source", "file", F.concat("path", F.array("step")).alias("path"), F.array(line, F.col("step"), F.col("step") + 4).alias("span"),
    )
    return declarations, spans


def nested_responses(spark, folder):
    """One file per order whose symbols nest up to 14 levels, some 200; the innermost of even orders is a flat one with a location."""
    depth = F.when(F.col("o_orderkey") % 1000 == 0, 200).otherwise(F.col("o_orderkey") % 14 + 1).cast("int")
    text = lambda c: c.cast("string")
    span = lambda i: F.concat(
        F.lit('{"start":{"line":'), text(i), F.lit(',"character":0},"end":{"line":'), text(i), F.lit(',"character":1}}'),
    )
    head = lambda i, kind: F.concat(F.lit('{"name":"attribute \\"n'), text(i), F.lit(f'\\"","kind":{kind},'))
    inner = lambda i: F.when(
        F.col("o_orderkey") % 2 == 0,
        F.concat(head(i, 13), F.lit('"location":{"uri":"x","range":'), span(i + 500), F.lit('},"children":['), head(i, 8), F.lit('"range":'), span(i), F.lit("}]}")),
    ).otherwise(F.concat(head(i, 8), F.lit('"range":'), span(i), F.lit("}")))
    nest = F.aggregate(
        F.sequence(depth, F.lit(1), F.lit(-1)), F.lit(""),
        lambda below, i: F.when(below == "", inner(i)).otherwise(
            F.concat(head(i, 8), F.lit('"range":'), span(i), F.lit(',"children":['), below, F.lit("]}"))),
    )
    uri = F.concat(F.lit(f"file://{TERRAFORM_ROOT}/deep/order_"), text(F.col("o_orderkey")), F.lit(".tf"))
    return table(spark, folder, "orders").select(repository().alias("source"), uri.alias("uri"), F.concat(F.lit("["), nest, F.lit("]")).alias("symbols"))


def proto_tables(edges):
    """One schema file per order with a message per line, a nested enum and a service."""
    lines = edges.filter("leads_line").select("source", "doc_id", "l_linenumber")
    file = F.concat(F.lit("api/order_"), F.col("doc_id").cast("string"), F.lit(".proto"))
    n = (F.col("l_linenumber") - 1).cast("int")
    text = F.col("l_linenumber").cast("string")
    message = F.concat(F.lit("Line"), text)
    fq = F.concat(F.lit(".shop.v1.Line"), text)

    def decl(path, kind, name, field_type=None, type_name=None, input_type=None, output_type=None):
        none = F.lit(None).cast("string")
        return path, kind, F.struct(
            F.array(*[step if not isinstance(step, int) else F.lit(step) for step in path]).alias("path"),
            F.lit(kind).alias("kind"), (F.lit(name) if isinstance(name, str) else name).alias("name"),
            F.lit(field_type).cast("int").alias("field_type"), (none if type_name is None else type_name).alias("type_name"),
            (none if input_type is None else input_type).alias("input_type"),
            (none if output_type is None else output_type).alias("output_type"),
        )

    per_line = [
        decl([4, n], "message", message),
        decl([4, n, 2, 0], "field", "state", 14, F.concat(fq, F.lit(".Detail.State"))),
        decl([4, n, 2, 1], "field", "note", 9),
        decl([4, n, 3, 0], "message", "Detail"),
        decl([4, n, 3, 0, 2, 0], "field", "parent", 11, fq),
        decl([4, n, 3, 0, 4, 0], "enum", "State"),
        decl([4, n, 3, 0, 4, 0, 2, 0], "value", "READY"),
        decl([6, n], "service", F.concat(F.lit("Svc"), text)),
        decl([6, n, 2, 0], "method", "Get", None, None, fq, F.concat(fq, F.lit(".Detail"))),
    ]
    declarations = lines.select(
        "source", file.alias("file"), F.lit("shop.v1").alias("package"), F.explode(F.array(*[d for _, _, d in per_line])).alias("d"),
    ).select("source", "file", "package", "d.*")
    # A span for each name and each named type; those of services leave their line.
    def span(step, path, kind):
        line = n * 20 + len(path)
        ends = {"service": (line, 0, line + 1, 4), "enum": (line, step, line, step + 5)}.get(kind, (line, step, step + 9))
        lits = lambda row: F.array(*[F.lit(v) if isinstance(v, int) else v for v in row])
        return F.struct(lits([*path, step]).alias("path"), lits(ends).alias("span"))

    named_types = {"field": (6,), "method": (2, 3)}
    spans = lines.select("source", file.alias("file"), F.inline(F.array(*[
        span(step, path, kind) for path, kind, _ in per_line for step in (1, *named_types.get(kind, ()))
    ])))
    return declarations, spans


TERRAFORM_ROOT = "/work/space"


def terraform_tables(edges):
    """One file per order whose symbols are its lines, each used once from the next file."""
    lines = edges.groupBy("source", "doc_id", "l_linenumber").agg(F.min("part_id").alias("part_id"))
    line = F.col("l_linenumber") * 10
    kind = F.element_at(F.array(*[F.lit(k) for k in (23, 5, 13, 8, 6)]), (F.col("l_linenumber") % 5 + 1).cast("int"))
    point = lambda a, b: F.struct(a.cast("int").alias("line"), F.lit(b).alias("character"))
    span = lambda a, b, c, d: F.struct(point(a, b).alias("start"), point(c, d).alias("end"))
    child = F.array(F.struct(
        F.lit('attribute "size"').alias("name"), F.lit(8).alias("kind"), span(line + 1, 2, line + 1, 6).alias("range"),
    ))
    node = F.struct(
        "l_linenumber", F.concat(F.lit('resource "item" "p'), F.col("part_id").cast("string"), F.lit('"')).alias("name"),
        kind.alias("kind"), span(line, 0, line, 8).alias("selectionRange"), span(line, 0, line + 5, 1).alias("range"),
        child.alias("children"),
    )
    uri = lambda key: F.concat(F.lit(f"file://{TERRAFORM_ROOT}/mod%20a/order_"), key.cast("string"), F.lit(".tf"))
    responses = lines.groupBy("source", "doc_id").agg(F.array_sort(F.collect_list(node)).alias("nodes")).select(
        "source", uri(F.col("doc_id")).alias("uri"), F.to_json("nodes").alias("symbols"),
    )
    references = lines.select(
        "source", uri(F.col("doc_id")).alias("uri"), line.alias("line"), F.lit(0).alias("character"),
        F.when(F.col("l_linenumber") == 7, F.concat(F.lit("https://host/"), F.col("doc_id").cast("string")))
        .when(F.col("l_linenumber") == 6, F.concat(F.lit("file:///elsewhere/shared_"), F.col("doc_id").cast("string"), F.lit(".tf")))
        .otherwise(uri(F.col("doc_id") + 1)).alias("target_uri"),
        span(line + 3, 4, line + 3, 12).alias("target_range"),
    )
    return responses, references


def star_occurrences(edges, rows=None):
    """Occurrences of the order documents: one per line item, some with enclosing ranges."""
    line = ((F.col("l_linenumber") - 1) * 20 + F.col("part_id") % 20).cast("int")
    char = (F.col("part_id") % 40).cast("int")
    end = (F.col("part_id") % 7 - 1).cast("int")
    made = edges.select(
        "source", F.concat(F.lit("order_"), F.col("doc_id").cast("string"), F.lit(".go")).alias("relative_path"),
        "symbol", "role", F.array(line, char, char + 5).alias("range"),
        F.when(F.col("part_id") % 2 == 0, F.array(line, char, line + end, F.lit(1))).alias("enclosing_range"),
    )
    # Hardly any repeats, so they are dealt out first; collected before, each task would keep all of its rows.
    return (made if rows is None else dealt(made, rows, "source", "relative_path")).distinct()


def star_symbol_info(occurrences, rows=None):
    """Descriptions of the symbols that are not local."""
    made = occurrences.filter(~F.startswith("symbol", F.lit("local"))).select("source", "relative_path", "symbol")
    found = (made if rows is None else dealt(made, rows, "source", "relative_path")).distinct()
    for field in schema.SYMBOL_INFO.fields:
        if field.name not in found.columns:
            found = found.withColumn(field.name, F.lit(None).cast(field.dataType))
    return found


MARKERS = (
    "package.json", "go.mod", "src/setup.cfg", "core/Cargo.toml", "build.gradle.kts", "infra/main.tf",
    "deploy/Chart.yaml", "api/v1.proto", "README.md",
)


def file_listing(spark, folder):
    """A marker file per order, spread over one repository per customer."""
    marker = F.element_at(F.array(*[F.lit(m) for m in MARKERS]), (F.col("o_orderkey") % 9 + 1).cast("int"))
    return table(spark, folder, "orders").select(
        F.concat(F.lit("team/repo-"), F.col("o_custkey").cast("string")).alias("repo"), marker.alias("path"),
    )


def deployment_listing(spark, folder):
    """Kustomization, chart, template and schema files; a folder per order."""
    key = F.col("o_orderkey").cast("string")
    folder_name = F.concat(F.lit("env/"), F.col("o_orderstatus"), F.lit("/app-"), key)
    files = F.array(
        F.when(F.col("o_orderkey") % 3 < 2, F.concat(folder_name, F.lit("/kustomization.yaml"))),
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(folder_name, F.lit("/Chart.yaml"))),
        F.when(F.col("o_orderkey") % 5 > 0, F.concat(folder_name, F.lit("/templates/app/main.yaml"))),
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(folder_name, F.lit("/buf.yaml"))),
        F.when(F.col("o_orderkey") % 11 == 0, F.concat(folder_name, F.lit("/proto/buf.work.yaml"))),
        F.when(F.col("o_orderkey") % 997 == 0, F.lit("buf.yaml")),
    )
    return table(spark, folder, "orders").select(
        F.concat(F.lit("repo-"), (F.col("o_custkey") % 50).cast("string")).alias("repo"),
        F.explode(F.filter(files, lambda f: f.isNotNull())).alias("path"),
        F.startswith("o_orderpriority", F.lit("1")).alias("remote_chart"),
    )


def snapshot_tables(spark, folder):
    """Requested keys and existing snapshots of one repository per customer."""
    repo = F.concat(F.lit("team/repo-"), F.col("o_custkey").cast("string"))
    sha = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("ab"), F.col("o_orderkey").cast("string"))).otherwise(
        F.md5(F.col("o_orderkey").cast("string")),
    )
    orders = table(spark, folder, "orders").select(
        repo.alias("repo"), sha.alias("head_sha"), F.col("o_orderdate").alias("modified"), "o_orderpriority",
    )
    snapshots = orders.filter(~F.startswith("o_orderpriority", F.lit("1"))).select(
        "repo", "head_sha", "modified", F.concat_ws("/", "repo", "head_sha").alias("path"),
    )
    return orders.select("repo", "head_sha"), snapshots
