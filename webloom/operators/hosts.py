"""Host rules (NO_PROXY semantics), CIDR membership, route assignment.

Two ways in. A short rule list is a job option (a comma-separated string): Spark splits it into a small rule table and
each row tests its own keys against the listed ones, without join or shuffle. A rule *table* of any size is joined:
only distinct hosts (addresses) meet the rules, by equality of their keys -- the exact host and every dot-suffix, or
the address masked to each prefix length that occurs -- and what they match goes back to the rows by host (address).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import js_trim
from ..functions.urls import settled

# Fixed test option: the rule list of the host jobs (exact, suffix, wildcard, port, CIDR entries).
DEFAULT_NO_PROXY = ("tiontion.example.net,.example.org,*.example.com,blog.tionsh.example.com:8080,"
                    "10.0.0.0/8,10.0.3.0/24,192.168.0.0/16")
DEFAULT_HTTP_PROXY = "http://proxy.example.net:3128"
DEFAULT_HTTPS_PROXY = ""

IPV4_RE = r"^([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})$"


def rule_table(spark: SparkSession, rules: str) -> DataFrame:
    """The rule string as rows ``(kind, key, bits, net)``, see :func:`parsed_rules`."""
    one = spark.createDataFrame([(rules,)], "rules string")
    return parsed_rules(one.select(F.explode(F.split("rules", ",")).alias("rule")))


def parsed_rules(rules: DataFrame) -> DataFrame:
    """``rules(rule)`` as distinct rows ``(kind, key, bits, net)``: kind 'all', 'exact', 'suffix' or 'cidr'.

    A port is cut off, ``*.`` stands for a leading dot, a plain name is an exact and a suffix rule, an entry with a
    slash is a network or, where it is no valid one, nothing.
    """
    entry = rules.select(F.lower(js_trim("rule")).alias("e")).filter("e <> ''")
    name = F.regexp_replace(F.regexp_replace("e", r"^(\[[^\]]+\]|[^:]+):[0-9]+$", "$1"), r"^\*\.", ".")
    parts = entry.select("e", name.alias("name"), F.substring_index("e", "/", 1).alias("base"),
                         js_trim(F.regexp_extract("e", "/([^:]*)", 1)).alias("length"))
    bits = F.when(F.col("length").rlike(r"^[0-9]+(\.0*)?$"), F.substring_index("length", ".", 1).try_cast("int")) \
        .when(F.col("length").rlike("^0x[0-9a-f]+$"), F.conv(F.substr(F.col("length"), F.lit(3)), 16, 10).try_cast("int"))
    shift = F.lit(32) - F.col("bits")
    none = F.lit(None)
    network = settled(parts.filter(F.contains("e", F.lit("/"))), [], {"bits": bits, "ip": ipv4_int(F.col("base"))}) \
        .filter("bits between 0 and 32 and ip is not null") \
        .select(F.lit("cidr").alias("kind"), none.cast("string").alias("key"), "bits", F.expr("shiftleft(shiftright(ip, 32 - bits), 32 - bits)").alias("net"))
    plain = parts.filter(~F.contains("e", F.lit("/")))
    dotted = F.col("name").startswith(".")
    names = plain.select(F.explode(F.when(F.col("e") == "*", F.array(F.struct(F.lit("all").alias("kind"), F.lit("*").alias("key"))))
                                   .when(dotted, F.array(F.struct(F.lit("suffix").alias("kind"), F.col("name").alias("key"))))
                                   .otherwise(F.array(F.struct(F.lit("exact").alias("kind"), F.col("name").alias("key")),
                                                      F.struct(F.lit("suffix").alias("kind"), F.concat(F.lit("."), "name").alias("key"))))).alias("r"))
    return names.select("r.kind", "r.key", none.cast("int").alias("bits"), none.cast("bigint").alias("net")).unionByName(network).distinct()


def host_keys(host: Column) -> Column:
    """array<struct<kind,key>>: the exact host and every suffix starting at a '.'"""
    h = host
    dots = F.filter(F.sequence(F.lit(1), F.greatest(F.length(h), F.lit(1))), lambda i: F.substring(h, i, 1) == ".")
    sufs = F.transform(dots, lambda i: F.struct(F.lit("suffix").alias("kind"), F.substr(h, i).alias("key")))
    return F.array_prepend(sufs, F.struct(F.lit("exact").alias("kind"), h.alias("key")))


def ipv4_int(ip: Column) -> Column:
    parts = [F.regexp_extract(ip, IPV4_RE, i).try_cast("bigint") for i in (1, 2, 3, 4)]
    ok = ip.rlike(IPV4_RE) & parts[0].between(0, 255) & parts[1].between(0, 255) \
        & parts[2].between(0, 255) & parts[3].between(0, 255)
    val = F.shiftleft(parts[0], 24) + F.shiftleft(parts[1], 16) + F.shiftleft(parts[2], 8) + parts[3]
    return F.when(ok, val)


def match_names(df: DataFrame, id_col: str, host_col: str, no_proxy: str) -> DataFrame:
    """``df`` + ``name_match`` (host matches an exact / suffix / wildcard rule).

    The rules of one option string are few: they become a literal list that a host's keys are tested against, so
    rows are neither exploded nor shuffled. ``id_col`` is not needed and kept for callers.
    """
    rules = rule_table(df.sparkSession, no_proxy).filter("kind <> 'cidr'").collect()
    if any(r.kind == "all" for r in rules):
        return df.withColumn("name_match", F.lit(True))
    if not rules:
        return df.withColumn("name_match", F.lit(False))
    listed = F.array(*[F.lit(f"{r.kind} {r.key}") for r in sorted(rules)])
    keys = F.transform(host_keys(F.lower(js_trim(F.col(host_col)))), lambda k: F.concat_ws(" ", k["kind"], k["key"]))
    return df.withColumn("name_match", F.coalesce(F.arrays_overlap(keys, listed), F.lit(False)))


def match_cidrs(df: DataFrame, id_col: str, ip_col: str, no_proxy: str) -> DataFrame:
    """``df`` + ``cidr_match`` (IPv4 address inside any network of the list): one masked test for each prefix length."""
    rules = rule_table(df.sparkSession, no_proxy).filter("kind in ('cidr', 'all')").collect()
    if any(r.kind == "all" for r in rules):
        return df.withColumn("cidr_match", F.lit(True))
    nets: dict[int, list[int]] = {}
    for r in rules:
        nets.setdefault(r.bits, []).append(r.net)
    ip, hit = ipv4_int(F.col(ip_col)), F.lit(False)
    for bits, own in sorted(nets.items()):
        masked = F.shiftleft(F.shiftright(ip, 32 - bits), 32 - bits)
        hit = hit | masked.isin(sorted(own))
    return df.withColumn("cidr_match", F.coalesce(hit, F.lit(False)))


def _holds_all(rules: DataFrame) -> bool:
    return not rules.filter("kind = 'all'").limit(1).isEmpty()


def match_name_table(df: DataFrame, host_col: str, rules: DataFrame) -> DataFrame:
    """J1 for a rule table: ``df`` + ``name_match`` and ``name_rules`` (how many distinct rule keys the host matches).

    ``rules``: rows of :func:`parsed_rules`, of any number. Each distinct host is exploded into its keys (as many as
    it has labels) and joined by equality; rows never are. A host that a third of all rows share is one row of that
    join, and a skewed key of the join back, which AQE splits on the side of the rows.
    """
    if _holds_all(rules):
        return df.withColumns({"name_match": F.lit(True), "name_rules": F.lit(None).cast("bigint")})
    host = F.lower(js_trim(F.col(host_col)))
    hosts = df.select(host.alias("_host")).filter("_host <> ''").distinct()
    keys = hosts.select("_host", F.explode(host_keys(F.col("_host"))).alias("k")).select("_host", "k.kind", "k.key")
    named = rules.filter("kind in ('exact', 'suffix')").select("kind", "key")
    hits = keys.join(named, ["kind", "key"]).groupBy("_host").agg(F.count("*").alias("name_rules"))
    out = df.withColumn("_host", host).join(hits, "_host", "left").drop("_host")
    return out.withColumns({"name_match": F.col("name_rules").isNotNull(), "name_rules": F.coalesce("name_rules", F.lit(0).cast("bigint"))})


#: Prefixes up to this length are at most 2^(n + 1) - 1 networks, a bound small enough to broadcast; an address meets
#: all others by a join on (bits, masked address), where no key is shared by more than 2^(31 - n) addresses.
WIDE_BITS = 12


def match_cidr_table(df: DataFrame, ip_col: str, rules: DataFrame) -> DataFrame:
    """J2 for a rule table: ``df`` + ``cidr_match`` and ``cidr_bits`` (length of the longest network that holds it)."""
    if _holds_all(rules):
        return df.withColumns({"cidr_match": F.lit(True), "cidr_bits": F.lit(None).cast("int")})
    nets = rules.filter("kind = 'cidr'").select("bits", "net").distinct()
    lengths = sorted(r.bits for r in nets.select("bits").distinct().collect())  # 33 at most
    ips = settled(df.select(ip_col), [], {"_ip": ipv4_int(F.col(ip_col))}).filter("_ip is not null").distinct()
    parts = []
    for of_table in ([b for b in lengths if b <= WIDE_BITS], [b for b in lengths if b > WIDE_BITS]):
        if of_table:
            own = nets.filter(F.col("bits").isin(of_table))
            keys = ips.select("_ip", F.explode(F.array(*[F.lit(b) for b in of_table])).alias("bits")) \
                .withColumn("net", F.expr("shiftleft(shiftright(_ip, 32 - bits), 32 - bits)"))
            parts.append(keys.join(F.broadcast(own) if max(of_table) <= WIDE_BITS else own, ["bits", "net"]).select("_ip", "bits"))
    if not parts:
        return df.withColumns({"cidr_match": F.lit(False), "cidr_bits": F.lit(None).cast("int")})
    hits = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    hits = hits.groupBy("_ip").agg(F.max("bits").alias("cidr_bits"))
    out = df.withColumn("_ip", ipv4_int(F.col(ip_col))).join(hits, "_ip", "left").drop("_ip")
    return out.withColumn("cidr_match", F.col("cidr_bits").isNotNull())


def route(scheme: Column, bypass: Column, http_proxy: str, https_proxy: str) -> Column:
    """J3: 'direct', 'proxy <url>' or an error for a non-http proxy URL."""
    def target(p: str) -> Column:
        if p == "":
            return F.lit("direct")
        if not p.lower().startswith("http:"):
            proto = p.split(":", 1)[0].lower() + ":" if ":" in p else p
            return F.lit(f'error: unsupported proxy protocol "{proto}"')
        return F.lit(f"proxy {p}")
    return F.when(bypass, F.lit("direct")).when(scheme == "https", target(https_proxy)).otherwise(target(http_proxy))
