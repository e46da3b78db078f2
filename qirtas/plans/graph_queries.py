"""Queries of graph patterns, writes, joins, aggregations, ids and checks over the whole relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qirtas.functions.html import derived_total
from qirtas.functions.normalize import range_bounds
from qirtas.graph import Graph, first_per, last_per
from qirtas.operators import joins, quality, resolve
from qirtas.plans.register import Register, table

register = Register()
query = register.query
CN, NR = ("PART_OF", "Customer", "Nation"), ("PART_OF", "Nation", "Region")
OC, LO = ("PLACED_BY", "Order", "Customer"), ("LINE_OF", "Line", "Order")


def commerce(spark: SparkSession, sf_dir: str) -> Graph:
    """Customers, nations, regions and orders as a graph."""
    read = lambda name: table(spark, sf_dir, name)
    g = Graph().create_nodes("Region", read("region"), "r_regionkey").create_nodes("Nation", read("nation"), "n_nationkey")
    g = g.create_nodes("Customer", read("customer"), "c_custkey").create_nodes("Order", read("orders"), "o_orderkey")
    g = g.create_edges(*NR, read("nation").select(F.col("n_nationkey").alias("src_key"), F.col("n_regionkey").alias("dst_key")))
    g = g.create_edges(*CN, read("customer").select(F.col("c_custkey").alias("src_key"), F.col("c_nationkey").alias("dst_key")))
    return g.create_edges(*OC, read("orders").select(F.col("o_orderkey").alias("src_key"), F.col("o_custkey").alias("dst_key")))


@query("SELECT n_nationkey AS nation_id, n_name AS name_latin, 'tpch' AS source, 'n:' || n_nationkey AS nation_key FROM nation")
def q01_project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renamed column lists, constants and built keys."""
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation_id"), F.col("n_name").alias("name_latin"), F.lit("tpch").alias("source"), F.concat_ws(":", F.lit("n"), F.col("n_nationkey").cast("string")).alias("nation_key"))


@query("SELECT tafsir_id, loaded_at FROM tafsir WHERE ayah_keys = group_ayah_key AND text_arabic IS NOT NULL AND trim(text_arabic) <> ''")
def q11_head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11, P04."""
    return table(spark, sf_dir, "tafsir").where("ayah_keys = group_ayah_key and text_arabic is not null and trim(text_arabic) <> ''").select("tafsir_id", "loaded_at")


@query("SELECT occ_id, is_oov <> 0 AS is_oov FROM word_occurrence WHERE hadith_id IS NOT NULL AND surface_norm IS NOT NULL AND surface_norm <> '' AND NOT regexp_matches(coalesce(surface_form, ''), '^[\\s\\x{0660}-\\x{0669}]+$')")
def f05_word_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P05, P07, P08, P17."""
    rows = table(spark, sf_dir, "word_occurrence").where("hadith_id is not null and surface_norm is not null and surface_norm <> ''")
    return rows.where(~F.coalesce("surface_form", F.lit("")).rlike("(?U)^[\\s\\x{0660}-\\x{0669}]+$")).select("occ_id", F.col("is_oov").cast("boolean").alias("is_oov"))


@query("SELECT DISTINCT replace(trim(o_orderpriority), '#', '') AS priority, o_custkey FROM orders WHERE (starts_with(o_orderpriority, '1-') OR starts_with(o_orderpriority, '2-')) AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def f10_prefix_not_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10, J16, U03, U04, N09."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderpriority").startswith("1-") | F.col("o_orderpriority").startswith("2-"))
    named = orders.select(F.replace(F.trim("o_orderpriority"), F.lit("#"), F.lit("")).alias("priority"), "o_custkey")
    seen = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return named.join(seen, "o_custkey", "left_anti").distinct().select("priority", "o_custkey")


@query("SELECT c_custkey AS src_key, n_nationkey AS dst_key, c_name AS s_c_name, n_name AS t_n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0")
def g03_one_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G03, P11."""
    rows = commerce(spark, sf_dir).match(*CN, ["c_name", "c_acctbal"], ["n_name"])
    return rows.where("s_c_acctbal > 0").select("src_key", "dst_key", "s_c_name", "t_n_name")


@query("SELECT o_orderkey AS k0, c_custkey AS k1, n_nationkey AS k2, r_regionkey AS k3 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def g06_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G06."""
    return commerce(spark, sf_dir).chain(OC, CN, NR)


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def g09_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an urgent order."""
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("src_key"), F.col("o_custkey").alias("dst_key"))
    g = commerce(spark, sf_dir).create_edges("URGENT", "Order", "Customer", urgent)
    return g.orphans("Customer", [("URGENT", "Order", "Customer")]).select("c_custkey")


@query(
    "SELECT 'PART_OF' AS kind, 'Customer' AS source_label, 'Nation' AS target_label, CAST(c_custkey AS VARCHAR) AS src_key, CAST(c_nationkey AS VARCHAR) AS dst_key FROM customer UNION ALL "
    "SELECT 'PART_OF', 'Nation', 'Region', CAST(n_nationkey AS VARCHAR), CAST(n_regionkey AS VARCHAR) FROM nation"
)
def g11_edges_of_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G11, U02."""
    return commerce(spark, sf_dir).edges_of("PART_OF").select("kind", "source_label", "target_label", "src_key", "dst_key")


@query("SELECT o_custkey AS src_key, o_orderkey AS dst_key, 1 AS rank FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)")
def g12_reverse_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G12, G13."""
    g = commerce(spark, sf_dir).reverse(*OC, "HAS_ORDER", rank=1).rename_edges("HAS_ORDER", "Customer", "Order", "ORDERED")
    return g.edges["ORDERED", "Customer", "Order"].select("src_key", "dst_key", "rank")


@query(
    "WITH gone AS (SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_name = (SELECT min(n_name) FROM nation)) "
    "SELECT 'node' AS what, 'Order' AS name, count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM gone) UNION ALL "
    "SELECT 'edge', 'PLACED_BY:Order:Customer', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM gone) UNION ALL "
    "SELECT 'node', 'Customer', count(DISTINCT o_custkey) FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM gone)"
)
def w15_scoped_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of one nation go with their edges, then customers without orders."""
    g = commerce(spark, sf_dir)
    first = table(spark, sf_dir, "nation").agg(F.min("n_name")).first()[0]
    g = g.delete_scope([OC, CN], F.col("n_name") == first).drop_orphans("Customer", [OC])
    return g.counts().where("name in ('Order', 'PLACED_BY:Order:Customer', 'Customer')")


@query("SELECT count(*) AS given, count(*) FILTER (o_custkey % 3 <> 0) AS written, count(*) FILTER (o_custkey % 3 = 0) AS dropped FROM orders")
def w19_edge_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges to customers that are not there are dropped, and counted."""
    g = Graph().create_nodes("Customer", table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0"), "c_custkey").create_nodes("Order", table(spark, sf_dir, "orders"), "o_orderkey")
    return g.edge_outcome("Order", "Customer", table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("src_key"), F.col("o_custkey").alias("dst_key")))


def _parts(spark: SparkSession, sf_dir: str) -> tuple[Graph, DataFrame]:
    g = Graph().create_nodes("Part", table(spark, sf_dir, "part"), "p_partkey").create_nodes("Supplier", table(spark, sf_dir, "supplier"), "s_suppkey")
    return g, table(spark, sf_dir, "lineitem").withColumnsRenamed({"l_partkey": "src_key", "l_suppkey": "dst_key"})


_ORDER = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]
_ENDS = "JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"


@query(f"SELECT DISTINCT l_partkey AS src_key, l_suppkey AS dst_key FROM lineitem {_ENDS}")
def w21_merge_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, rows = _parts(spark, sf_dir)
    g = g.merge_edges("SOLD", "Part", "Supplier", rows.select("src_key", "dst_key"))
    return g.edges["SOLD", "Part", "Supplier"]


@query(f"SELECT l_partkey AS src_key, l_suppkey AS dst_key, l_returnflag, arg_max(l_extendedprice, ({', '.join(_ORDER)})) AS price FROM lineitem {_ENDS} GROUP BY l_partkey, l_suppkey, l_returnflag")
def w22_merge_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges keyed by their ends and a property, the last sets the rest."""
    g, rows = _parts(spark, sf_dir)
    g = g.merge_edges_set("SOLD", "Part", "Supplier", rows.select("src_key", "dst_key", "l_returnflag", *_ORDER), _ORDER, ["l_returnflag"])
    return g.edges["SOLD", "Part", "Supplier"].select("src_key", "dst_key", "l_returnflag", F.col("l_extendedprice").alias("price"))


@query(f"SELECT l_partkey AS src_key, l_suppkey AS dst_key, arg_max(l_quantity, ({', '.join(_ORDER)})) AS quantity FROM lineitem {_ENDS} GROUP BY l_partkey, l_suppkey")
def w23_merge_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W23, O13."""
    g, rows = _parts(spark, sf_dir)
    g = g.merge_edges_set("SOLD", "Part", "Supplier", rows.select("src_key", "dst_key", *_ORDER), _ORDER)
    return g.edges["SOLD", "Part", "Supplier"].select("src_key", "dst_key", F.col("l_quantity").alias("quantity"))


@query(f"WITH m AS (SELECT l_partkey, arg_max(l_suppkey, ({', '.join(_ORDER)}, l_suppkey)) AS l_suppkey FROM lineitem GROUP BY l_partkey) SELECT p_partkey, p_name, l_suppkey FROM part LEFT JOIN m ON p_partkey = l_partkey")
def j01_last_wins_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J01, J02."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lookup = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", *_ORDER)
    rows = joins.last_wins_lookup(part, lookup.withColumn("_last", F.col("l_suppkey")), ["l_partkey"], [*_ORDER, "_last"])
    return rows.select(F.col("l_partkey").alias("p_partkey"), "p_name", "l_suppkey")


@query(
    "WITH r AS (SELECT r_regionkey, r_regionkey * 10 + 1 AS lo, CASE WHEN r_regionkey = 4 THEN r_regionkey * 10 + 1 ELSE r_regionkey * 10 + 10 END AS hi FROM region) "
    "SELECT p_partkey, p_size, r_regionkey FROM part LEFT JOIN r ON p_size BETWEEN lo AND hi"
)
def j04_range_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges as JSON text {"key": "a-b"} or {"key": "n"}."""
    low = F.col("r_regionkey") * 10 + 1
    text = F.concat(F.lit('{"'), F.col("r_regionkey").cast("string"), F.lit('": "'), low.cast("string"), F.when(F.col("r_regionkey") == 4, "").otherwise(F.concat(F.lit("-"), (low + 9).cast("string"))), F.lit('"}'))
    maps = table(spark, sf_dir, "region").select(F.explode(F.from_json(text, "map<string,string>")).alias("key", "range"))
    ranges = joins.expand_ranges(maps, *range_bounds(F.col("range")), "p_size").select(F.col("key").cast("int").alias("r_regionkey"), "p_size")
    return table(spark, sf_dir, "part").select("p_partkey", "p_size").join(ranges, "p_size", "left").select("p_partkey", "p_size", "r_regionkey")


_NUMBERED = "(o_custkey % 50)::VARCHAR || CASE WHEN o_orderkey % 7 = 0 THEN '.0' ELSE '' END"


@query(
    "WITH i AS (SELECT c_mktsegment AS seg, (c_custkey % 50)::VARCHAR AS nr, min(c_custkey) AS hit FROM customer GROUP BY 1, 2 HAVING count(*) = 1), "
    "m AS (SELECT o_orderkey, hit FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN i ON seg = c_mktsegment AND nr = (o_custkey % 50)::VARCHAR) "
    "SELECT 'linked' AS outcome, count(DISTINCT hit) AS n FROM m UNION ALL SELECT 'duplicate', count(hit) - count(DISTINCT hit) FROM m UNION ALL SELECT 'skipped', count(*) - count(hit) FROM m"
)
def j06_unique_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J06, J08, N07, A06, A12."""
    from qirtas.functions.normalize import normalize_nomor

    customer = table(spark, sf_dir, "customer")
    index = customer.select(F.col("c_mktsegment").alias("seg"), normalize_nomor((F.col("c_custkey") % 50).cast("string")).alias("nr"), F.col("c_custkey").alias("hit"))
    number = F.concat((F.col("o_custkey") % 50).cast("string"), F.when(F.col("o_orderkey") % 7 == 0, ".0").otherwise(""))
    cited = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_mktsegment").alias("seg"), normalize_nomor(number).alias("nr"))
    return joins.match_outcomes(joins.unique_match(cited, index, ["seg", "nr"], "hit"), "hit", ["hit"])


@query("SELECT c_custkey, n_nationkey FROM customer LEFT JOIN nation ON n_name = (SELECT n_name FROM nation x WHERE x.n_nationkey = c_nationkey) AND c_custkey % 3 <> 2")
def j09_fallback_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as they are, in another case, and unknown."""
    nation = table(spark, sf_dir, "nation")
    named = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.col("n_name")).when(F.col("c_custkey") % 3 == 1, F.lower("n_name")).otherwise("nowhere").alias("n_name"))
    return joins.fallback_lookup(named, nation, "n_name", "n_nationkey", F.lower).select("c_custkey", "n_nationkey")


@query("WITH m AS (SELECT top_lemma_id AS k, count(*) AS n FROM word_occurrence GROUP BY 1) SELECT occ_id, n FROM word_occurrence LEFT JOIN m ON top_lemma_id IS NOT DISTINCT FROM k")
def j11_null_safe_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null key is a key like any other."""
    words = table(spark, sf_dir, "word_occurrence").select("occ_id", "top_lemma_id")
    mapping = words.groupBy("top_lemma_id").agg(F.count(F.lit(1)).alias("n"))
    return joins.null_safe_remap(words, mapping, "top_lemma_id", "n").select("occ_id", "n")


@query(
    "WITH k AS (SELECT tafsir_id, min(loaded_at) AS at FROM tafsir GROUP BY 1), b AS (SELECT t.tafsir_id, arg_min(ayah_keys, t.loaded_at) AS keys FROM tafsir t WHERE ayah_keys IS NOT NULL GROUP BY 1), "
    "e AS (SELECT tafsir_id, i, list_transform(list_filter(string_split(keys, ','), lambda x: x <> ''), lambda x: x)[i] AS key FROM (SELECT *, unnest(range(1, len(list_filter(string_split(keys, ','), lambda x: x <> '')) + 1)) AS i FROM b)), "
    "h AS (SELECT e.tafsir_id, i, surah_number, text FROM e JOIN ayah ON verse_key = key), "
    "g AS (SELECT tafsir_id, surah_number, min(i) AS i, arg_min(coalesce(text, chr(1)), i) AS text FROM h GROUP BY 1, 2) "
    "SELECT b.tafsir_id AS block_key, (SELECT string_agg(text, chr(10) || chr(10) ORDER BY i) FROM g WHERE g.tafsir_id = b.tafsir_id AND text <> chr(1)) AS text FROM b"
)
def j15_merge_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per commentary block the first verse text of every chapter it names."""
    blocks = first_per(table(spark, sf_dir, "tafsir").where("ayah_keys is not null").select("tafsir_id", "loaded_at", "ayah_keys"), ["tafsir_id"], ["loaded_at"])
    keys = F.filter(F.split("ayah_keys", ","), lambda x: x != "")
    side = table(spark, sf_dir, "ayah").select(F.col("verse_key").alias("key"), F.col("surah_number").cast("string").alias("group_key"), "text", "loaded_at")
    return joins.merge_sides(blocks.select(F.col("tafsir_id").alias("block_key"), keys.alias("keys")), side, ["loaded_at"])


@query(f"WITH v AS (SELECT l_partkey, l_suppkey, count(*) AS votes, min(l_orderkey) AS f FROM lineitem GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY votes DESC, f, l_suppkey) AS k, count(*) OVER (PARTITION BY l_partkey) AS n_values FROM v) SELECT l_partkey, l_suppkey, votes, n_values FROM r WHERE k = 1")
def a05_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A05."""
    return resolve.majority(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey", "l_orderkey")


@query("SELECT source, count(*) AS n, count_if(surface_norm IS NULL) AS n_null, count(DISTINCT top_lemma_id) AS n_lemmas, round(count_if(is_oov = 1) / count(*), 6) AS oov_part, round(count_if(n_candidates > 1) / count(*), 6) AS ambiguous_part FROM word_occurrence GROUP BY source")
def a03_grouped_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A01-A04, D08."""
    part = lambda c: F.round(F.count_if(c) / F.count(F.lit(1)), 6)
    return table(spark, sf_dir, "word_occurrence").groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("surface_norm").isNull()).alias("n_null"), F.countDistinct("top_lemma_id").alias("n_lemmas"), part(F.col("is_oov") == 1).alias("oov_part"), part(F.col("n_candidates") > 1).alias("ambiguous_part")
    )


@query("WITH k AS (SELECT book_id, tafsir_id, len(list_filter(string_split(coalesce(ayah_keys, ''), ','), lambda x: x <> '')) AS n, text_arabic, group_ayah_key FROM tafsir) SELECT book_id, count(*) AS n_blocks, count_if(text_arabic IS NULL OR trim(text_arabic) = '') AS without_text, count_if(n > 1) AS merging, count(*) - count(DISTINCT group_ayah_key) AS reused FROM k GROUP BY book_id")
def a08_block_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = F.size(F.filter(F.split(F.coalesce("ayah_keys", F.lit("")), ","), lambda x: x != ""))
    rows = table(spark, sf_dir, "tafsir").withColumn("n", keys)
    blank = F.col("text_arabic").isNull() | (F.trim("text_arabic") == "")
    reused = F.count(F.lit(1)) - F.countDistinct("group_ayah_key")
    return rows.groupBy("book_id").agg(F.count(F.lit(1)).alias("n_blocks"), F.count_if(blank).alias("without_text"), F.count_if(F.col("n") > 1).alias("merging"), reused.alias("reused"))


@query("WITH t AS (SELECT c_nationkey, (max(c_custkey) - 1) * CASE WHEN count(*) % 5 = 0 THEN 10 ELSE count(*) % 5 END + count(*) AS total FROM customer GROUP BY c_nationkey) SELECT c_nationkey, total, (SELECT CAST(sum(total) AS BIGINT) FROM t) AS grand FROM t")
def a11_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A09-A11."""
    n = F.count(F.lit(1))
    rows = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(derived_total(F.max("c_custkey"), n % 5, n).alias("total"))
    return rows.join(F.broadcast(rows.agg(F.sum("total").alias("grand"))))  # one row


@query("SELECT user_id, event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS carried, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS following FROM events")
def o03_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O01, O03, O04."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    opened = F.when(F.col("event_type") == "purchase", F.col("event_id"))
    return table(spark, sf_dir, "events").select("user_id", "event_id", F.last(opened, ignorenulls=True).over(before).alias("carried"), F.lead("event_id").over(order).alias("following"))


@query("WITH p AS (SELECT DISTINCT p_brand, p_type FROM part) SELECT p_brand, p_type, row_number() OVER (ORDER BY p_brand, p_type) - 1 AS id FROM p")
def o07_dense_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.dense_ids(table(spark, sf_dir, "part").select("p_brand", "p_type").distinct(), ["p_brand", "p_type"], "id").select("p_brand", "p_type", "id")


@query("WITH f AS (SELECT surface_norm, min(occ_id) AS at_ FROM word_occurrence WHERE surface_norm NOT IN (SELECT text FROM lemma WHERE text IS NOT NULL) GROUP BY 1) SELECT surface_norm AS text, 'L' || ((SELECT max(lemma_id) + 1 FROM lemma) + row_number() OVER (ORDER BY at_) - 1) AS new_id FROM f")
def o08_next_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O08, O09, A09, E07, J17."""
    words = table(spark, sf_dir, "word_occurrence").where("surface_norm is not null").select(F.col("surface_norm").alias("text"), "occ_id")
    known = table(spark, sf_dir, "lemma").select("text", "lemma_id")
    return resolve.next_ids(words, known, "text", ["occ_id"], "lemma_id").select("text", F.concat(F.lit("L"), F.col("lemma_id").cast("string")).alias("new_id"))


@query("SELECT o_custkey, o_orderkey, CAST(k AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k <= 3 AND o_totalprice >= 1000")
def o11_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The threshold comes after the ranking."""
    order = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    ranked = table(spark, sf_dir, "orders").withColumn("rank", F.row_number().over(order)).where("rank <= 3")
    return ranked.where("o_totalprice >= 1000").select("o_custkey", "o_orderkey", "rank")


_DEDUP = "trim(translate(regexp_replace(regexp_replace({}, '[0-9]+$', ''), '[\\x{{064B}}-\\x{{065F}}\\x{{0670}}\\x{{06D6}}-\\x{{06ED}}\\x{{0640}}]', '', 'g'), 'إأآىة', 'ااايه'))"


def _roots(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    first = table(spark, sf_dir, "root").select(F.col("root_id").alias("old_id"), F.col("arabic_trilateral").alias("text"), F.col("english_trilateral").alias("english"))
    second = table(spark, sf_dir, "lemma").where("root is not null and root <> ''").groupBy(F.col("root").alias("text")).agg(F.min("lemma_id").alias("old_id")).select("old_id", "text", F.lit(None).cast("string").alias("english"))
    return [first, second]


@query(
    f"WITH s AS (SELECT 0 AS r, root_id AS o, arabic_trilateral AS t, english_trilateral AS e FROM root UNION ALL SELECT 1, min(lemma_id), root, NULL FROM lemma WHERE root <> '' GROUP BY root), k AS (SELECT *, {_DEDUP.format('t')} AS k FROM s), "
    "w AS (SELECT k, min((r, o)) AS at_, arg_min((t, e), (r, o)) AS v FROM k GROUP BY k) SELECT row_number() OVER (ORDER BY at_) - 1 AS root_id, v[1] AS arabic_trilateral, v[2] AS english_trilateral FROM w"
)
def e01_merge_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E01, O07, O13."""
    return resolve.merge_roots(_roots(spark, sf_dir))[0]


def _lemma_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    none = [F.lit(None).cast(t).alias(n) for n, t in (("pos", "string"), ("frequency", "long"), ("source", "string"))]
    words = table(spark, sf_dir, "word_occurrence").where("source = 'tafsir' and surface_norm is not null").groupBy(F.col("surface_norm").alias("text")).agg(F.min("occ_id").alias("old_id"))
    full = table(spark, sf_dir, "lemma").select(F.col("lemma_id").alias("old_id"), "text", "pos", "frequency", "source")
    return [full.where("old_id % 2 = 0").select("old_id", "text", *none), words.select("old_id", "text", *none), full]


@query(
    "WITH s AS (SELECT 0 AS r, lemma_id AS o, text AS t, NULL AS p, NULL AS f, NULL AS c FROM lemma WHERE lemma_id % 2 = 0 UNION ALL SELECT 1, min(occ_id), surface_norm, NULL, NULL, NULL FROM word_occurrence WHERE source = 'tafsir' AND surface_norm IS NOT NULL GROUP BY surface_norm "
    f"UNION ALL SELECT 2, lemma_id, text, pos, frequency, source FROM lemma), k AS (SELECT *, {_DEDUP.format('t')} AS k FROM s), "
    "w AS (SELECT k, min((r, o)) AS at_, arg_min((r, t), (r, o)) AS v, arg_min((p, f, c), o) FILTER (r = 2) AS x FROM k GROUP BY k) "
    "SELECT row_number() OVER (ORDER BY at_) - 1 AS lemma_id, CASE WHEN v[1] = 2 THEN regexp_replace(v[2], '[0-9]+$', '') ELSE v[2] END AS text, x[1] AS pos, x[2] AS frequency, x[3] AS source FROM w"
)
def e02_merge_lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sources, the last enriches."""
    return resolve.merge_lemmas(_lemma_sources(spark, sf_dir), 2)[0]


@query()
def e03_lemma_root_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direct edges remapped to merged ids."""
    lemmas, lemma_ids = resolve.merge_lemmas(_lemma_sources(spark, sf_dir), 2)
    roots, root_ids = resolve.merge_roots(_roots(spark, sf_dir))
    direct = table(spark, sf_dir, "lemma").where("root is not null and root <> ''").select(F.col("lemma_id").alias("old_id"), F.col("root").alias("text"))
    ids = direct.join(lemma_ids.where("source_rank = 2").select("old_id", "lemma_id"), "old_id")
    by_text = _roots(spark, sf_dir)[1].select("old_id", "text").join(root_ids.where("source_rank = 1").select("old_id", "root_id"), "old_id").select("text", "root_id")
    return ids.join(by_text, "text").select("lemma_id", "root_id").distinct()


@query(
    "WITH e(name, expected) AS (VALUES ('Region', 5), ('Nation', 25), ('Customer', 150), ('Missing', 0)), c AS (SELECT 'Region' AS name, count(*) AS n FROM region UNION ALL SELECT 'Nation', count(*) FROM nation UNION ALL SELECT 'Customer', count(*) FROM customer) "
    "SELECT e.name, coalesce(n, 0) AS n, CAST(expected AS BIGINT) AS expected, expected = 0 OR abs(coalesce(n, 0) - expected) <= 0.1 * expected AS ok FROM e LEFT JOIN c ON c.name = e.name"
)
def d01_expected_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D01, D02."""
    expected = spark.createDataFrame([("Region", 5), ("Nation", 25), ("Customer", 150), ("Missing", 0)], "name string, expected long")
    return quality.check_counts(commerce(spark, sf_dir).counts(), expected, 0.1)


@query("SELECT count(DISTINCT k) AS covered, (SELECT count(DISTINCT verse_key) FROM ayah) AS total, round(count(DISTINCT k) / (SELECT count(DISTINCT verse_key) FROM ayah), 6) AS part FROM (SELECT trim(unnest(string_split(ayah_keys, ','))) AS k FROM tafsir) WHERE k IN (SELECT verse_key FROM ayah)")
def d03_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "tafsir").select(F.explode(F.transform(F.split("ayah_keys", ","), lambda x: F.trim(x))).alias("k"))
    return quality.coverage(keys, "k", table(spark, sf_dir, "ayah"), "verse_key")


@query(
    "WITH p AS (SELECT (SELECT count(*) FROM word_occurrence WHERE source = 'hadith') + (SELECT count(*) FROM word_occurrence WHERE source = 'tafsir') + (SELECT count(*) FROM word_occurrence WHERE source IS NULL OR source NOT IN ('hadith', 'tafsir')) AS sum_of_parts) "
    "SELECT sum_of_parts, (SELECT count(*) FROM word_occurrence) AS whole, sum_of_parts = (SELECT count(*) FROM word_occurrence) AS ok FROM p"
)
def d05_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "word_occurrence")
    parts = [words.where("source = 'hadith'"), words.where("source = 'tafsir'"), words.where("source is null or source not in ('hadith', 'tafsir')")]
    return quality.conserved(parts, words)


@query(f"WITH s AS (SELECT arabic_trilateral AS t FROM root UNION ALL SELECT DISTINCT root FROM lemma WHERE root <> '') SELECT count(DISTINCT coalesce({_DEDUP.format('t')}, chr(1))) AS merged, count(*) AS naive, count(DISTINCT {_DEDUP.format('t')}) < count(*) AS ok FROM s")
def d06_shrink(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = _roots(spark, sf_dir)
    return quality.shrunk(resolve.merge_roots(sources)[0], sources)


@query("SELECT table_name, n FROM (SELECT 'region' AS table_name, count(*) AS n FROM region UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'lineitem', count(*) FROM lineitem)")
def s11_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    from qirtas.sources.files import catalog_counts

    return catalog_counts(spark, {n: f"{sf_dir}/{n}.parquet" for n in ("region", "nation", "lineitem")})
