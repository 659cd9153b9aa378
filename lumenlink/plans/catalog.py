"""The engine's queries over the driver's tables, and the same in SQL.

Linkage inputs are whole tables: ``parts`` links parts to parts by name within
a brand; ``accounts`` links customers to suppliers by name within a nation;
``texts`` links benchmark items to documents and conversation turns by their
whole texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumenlink.functions import similarity, text
from lumenlink.operators import blocking, evaluate, features, model, predict
from lumenlink.plans import lifecycles
from lumenlink.schema import BlockingOptions, TfidfOptions
from lumenlink.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
K = 30


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- inputs


def parts(spark, sf_dir):
    """Parts as source rows: name p_name, address p_type (none for sizes divisible by 7), country p_brand."""
    p = table(spark, sf_dir, "part")
    address = F.when(F.col("p_size") % 7 != 0, F.col("p_type")).otherwise("")
    return p.select(F.concat(F.lit("P-"), "p_partkey").alias("entity_id"), F.col("p_name").alias("business_name"), address.alias("business_address"), F.col("p_brand").alias("country"))


def accounts(spark, sf_dir):
    """(customers, suppliers) as source rows: the country is the nation's name, the address is the number."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    c = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    s = table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return (
        c.select(F.concat(F.lit("C-"), "c_custkey").alias("entity_id"), F.col("c_name").alias("business_name"), F.col("c_mktsegment").alias("business_address"), F.col("n_name").alias("country")),
        s.select(F.concat(F.lit("S-"), "s_suppkey").alias("entity_id"), F.col("s_name").alias("business_name"), F.lit("").alias("business_address"), F.col("n_name").alias("country")),
    )


def documents(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(F.concat(F.lit("D-"), "doc_id").alias("entity_id"), F.col("text").alias("business_name"), F.lit("").alias("business_address"), F.col("lang").alias("country"))


def texts(spark, sf_dir, countries: bool = False):
    """(benchmark items, [documents, conversation turns]) as source rows; ``countries``: items have none, en or fr by turns, documents their language."""
    country = F.element_at(F.array(F.lit(""), F.lit("EN"), F.lit("fr ")), (F.col("item_id") % 3 + 1).cast("int")) if countries else F.lit("")
    b = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("B-"), "item_id").alias("entity_id"), F.col("text").alias("business_name"), F.lit("").alias("business_address"), country.alias("country"))
    d = documents(spark, sf_dir)
    d = d if countries else d.withColumn("country", F.lit(""))
    v = table(spark, sf_dir, "conversations").select(F.concat(F.lit("V-"), "conv_id", F.lit("."), "turn").alias("entity_id"), F.col("text").alias("business_name"), F.lit("").alias("business_address"), F.lit("").alias("country"))
    return b, [d, v]


# ---------------------------------------------------------------- SQL pieces

WS = text.WS
_STRIP = f"'^[{WS}]+|[{WS}]+$'"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, {_STRIP}, '', 'g')"


def sql_squeeze(x: str) -> str:
    return sql_strip(f"regexp_replace({x}, '[{WS}]{{2,}}', ' ', 'g')")


def sql_alnum(x: str) -> str:
    return f"regexp_replace({x}, '[^a-z0-9{WS}]', ' ', 'g')"


def sql_token(x: str) -> str:
    return sql_squeeze(sql_alnum(f"lower(coalesce({x}, ''))"))


def sql_tfidf(x: str) -> str:
    y = sql_alnum(f"lower(coalesce({x}, ''))")
    for k, v in text.LEGAL_WORDS.items():
        if k != v:
            y = f"regexp_replace({y}, '\\b{k}\\b', '{v}', 'g')"
    return sql_squeeze(y)


def sql_words(x: str, least: int = 3) -> str:
    return f"list_distinct(list_filter(regexp_split_to_array({x}, '[{WS}]+'), lambda w: length(w) >= {least}))"


def sql_country(x: str) -> str:
    return f"lower({sql_strip(f'coalesce({x}, {chr(39)}{chr(39)})')})"


def sql_raw(x: str) -> str:
    return sql_strip(f"lower(coalesce({x}, ''))")


SQL_PARTS = f"""parts as (
  select 'P-' || p_partkey as id, {sql_token("p_name")} as name, {sql_country("p_brand")} as country, p_name, case when p_size % 7 <> 0 then p_type else '' end as p_type, p_brand from part)"""
SQL_TEXTS = f"""q as (select 'B-' || item_id as id, {sql_token("text")} as name, '' as country, text as body0 from benchmark),
t as (
  select 0 as src, 'D-' || doc_id as id, {sql_token("text")} as name, '' as country, text as body0 from documents
  union all
  select 1, 'V-' || conv_id || '.' || turn, {sql_token("text")}, '', text from conversations)"""


def sql_scores(max_df: int, least: int = 3) -> str:
    """CTEs from q (id, name, country) and t (src, id, name, country) to scored (query_id, src, target_id, score)."""
    return f"""
qw as (select id, country, unnest({sql_words("name", least)}) as token from q),
tw as (select src, id, country, unnest({sql_words("name", least)}) as token from t),
rare as (select token, country from tw group by 1, 2 having count(*) < {max_df}),
hits as (
  select qw.id as query_id, tw.src, tw.id as target_id, 1 as points
  from qw join rare using (token, country) join tw using (token, country)
  union all
  select q.id, t.src, t.id, 1000 from q join t using (name, country) where q.name <> ''),
scored as (select query_id, src, target_id, cast(sum(points) as bigint) as score from hits group by 1, 2, 3),
ranked as (select *, row_number() over (partition by query_id order by score desc, src, target_id) as rank from scored)"""


PARTS_Q_T = SQL_PARTS + ", q as (select id, name, country from parts), t as (select 0 as src, id, name, country from parts)"
OPTIONS = BlockingOptions(k=K)


def part_records(spark, sf_dir):
    r = lifecycles.token_records(parts(spark, sf_dir))
    return r, r.withColumn("src", F.lit(0))


def part_candidates(spark, sf_dir):
    q, t = part_records(spark, sf_dir)
    return blocking.block_tokens(q, t, OPTIONS)


def text_records(spark, sf_dir):
    b, sources = texts(spark, sf_dir)
    return lifecycles.token_records(b), lifecycles.token_records(tables.union_targets(*sources))



# ---------------------------------------------------------------- normalisation


@query(f"select doc_id, {sql_token('text')} as name from documents")
def norm_name_token(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.name_token(F.col("text")).alias("name"))


@query(f"select doc_id, {sql_tfidf('text')} as name from documents")
def norm_name_tfidf(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.name_tfidf(F.col("text")).alias("name"))


def _company(c):
    return F.concat_ws(" ", c, F.element_at(F.array(*[F.lit(w) for w in ("Pvt. Ltd", "CORP", "(Inc)", "& Co.", "Intl Mfg Svcs")]), (F.length(c) % 5 + 1).cast("int")))


@query(f"select p_partkey, {sql_tfidf("p_name || ' ' || (['Pvt. Ltd', 'CORP', '(Inc)', '& Co.', 'Intl Mfg Svcs'])[length(p_name) % 5 + 1]")} as name from part")
def norm_name_legal(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.name_tfidf(_company(F.col("p_name"))).alias("name"))


def _sql_states(x: str, states: dict[str, str]) -> str:
    """No lookbehind in RE2: a mark follows each separator, so that neighbours do not share one."""
    for k in sorted(states, key=len, reverse=True):
        x = f"regexp_replace({x}, '(^|[^a-z]){k.replace(' ', ' \\x01')}([^a-z]|$)', '\\1{states[k]}\\2', 'g')"
    return x


STATED = ("Illinois", "West  Virginia, Virginia", "Tamil Nadu", "New York", "Indiana St, Delhi", "New\tYork", "New  York", "northcarolina, NORTH CAROLINA.")


def sql_choice(values: tuple[str, ...], key: str) -> str:
    """One of the values by turns."""
    return f"([{', '.join('e' + repr(v) for v in values)}])[cast({key} % {len(values)} + 1 as int)]"


def choice(values: tuple[str, ...], key: str):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values) + 1).cast("int"))


def sql_codes(x: str, india: dict[str, str]) -> str:
    """States for codes; ``x`` is in lower case."""
    marked = f"regexp_replace({x}, '([^a-z0-9])', '\\1' || chr(1), 'g')"
    return f"replace({_sql_states(_sql_states(marked, text.US_STATES), india)}, chr(1), '')"


_ADDRESS = f"'No. ' || s_suppkey || ', P.O. Box 12-A, ' || s_name || ' Road, ' || {sql_choice(STATED, 's_suppkey')}"


@query("select s_suppkey, " + sql_squeeze(sql_alnum(sql_codes(f"regexp_replace(lower({_ADDRESS}), 'p\\.?\\s*o\\.?\\s*box\\s*[0-9a-z_\\-]*', '', 'g')", text.INDIA_STATES))) + " as address from supplier")
def norm_address_states(spark, sf_dir):
    address = F.concat(F.lit("No. "), "s_suppkey", F.lit(", P.O. Box 12-A, "), "s_name", F.lit(" Road, "), choice(STATED, "s_suppkey"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.address_tfidf(address).alias("address"))


@query(f"select doc_id, {sql_raw('text')} as raw, {sql_country('lang')} as country from documents")
def norm_raw_country(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.raw(F.col("text")).alias("raw"), text.country(F.col("lang")).alias("country"))


SUFFIXES = (" [Co]", " (Pvt) Ltd.", " L.T.Designs", " P.V.T. L.T.D", " T/A Blue", " TA Tech Intl", ", Inc.", " Assoc Grp Mgmt", " Svcs GmbH PLC", " P.V.Technology", " <Corp.>", " {Sol}  Mfg", " dba Pte. LLP", "")
PLACES = (
    "No. 12-A, Near Str, New York", "PO Box 77, New  York", "P.O. Box, Goa", "p. o. box 9 opp Ave Blvd, Iowa", "Pin Code 12, Ste 4 Bldg 5, Delhi", "no.7 behind Pkwy; West Bengal", "Hwy 9/Fwy 3 Flr 2 Apt 1",
    "adjacent Cir, Pincode 560001, Goa Karnataka", "New\tHampshire", "", "po box near Washington",
)


def sql_rich_name(x: str) -> str:
    y = f"regexp_replace(lower({x}), '[\\[\\](){{}}<>]', ' ', 'g')"
    for k, v in ({r"p\.v\.t": "private", r"l\.t\.d": "limited", "t/a": "dba"} | text.RICH_LEGAL_WORDS).items():
        y = f"regexp_replace({y}, '\\b{k}\\b', '{v}', 'g')"
    return sql_squeeze(sql_alnum(y))


def sql_rich_address(x: str) -> str:
    y = f"regexp_replace(lower({x}), 'p\\.?\\s*o\\.?\\s*box\\s*\\d+', '', 'g')"
    for k, v in text.ADDRESS_WORDS.items():
        y = f"regexp_replace({y}, '\\b{k}\\b', ' {v} ', 'g')"
    y = f"regexp_replace({y}, '\\bno\\.\\s*([\\d\\-]+)', ' number \\1 ', 'g')"
    for k in text.ADDRESS_NOISE:
        y = f"regexp_replace({y}, '\\b{k}\\b', '  ', 'g')"
    return sql_squeeze(sql_alnum(sql_codes(y, text.RICH_INDIA_STATES)))


_RICH_NAME, _RICH_ADDRESS = sql_rich_name(f"p_name || {sql_choice(SUFFIXES, 'p_partkey')}"), sql_rich_address(f"p_partkey || ' ' || {sql_choice(PLACES, 'p_partkey')}")


@query(f"select entity_id, norm_name, norm_addr, trim(norm_name || ' ' || norm_addr) as combined, country from (select 'P-' || p_partkey as entity_id, {_RICH_NAME} as norm_name, {_RICH_ADDRESS} as norm_addr, {sql_country('p_brand')} as country from part)")
def normalize_record(spark, sf_dir):
    """The rich profile of part names with legal forms in many spellings, and of addresses by turns."""
    p = table(spark, sf_dir, "part")
    name, address = F.concat("p_name", choice(SUFFIXES, "p_partkey")), F.concat_ws(" ", F.col("p_partkey").cast("string"), choice(PLACES, "p_partkey"))
    return lifecycles.rich_records(p.select(F.concat(F.lit("P-"), "p_partkey").alias("entity_id"), name.alias("business_name"), address.alias("business_address"), F.col("p_brand").alias("country")))


# ---------------------------------------------------------------- sources and lists


@query("select 0 as src, 'C-' || c_custkey as entity_id, c_name as business_name from customer union all select 1, 'S-' || s_suppkey, s_name from supplier")
def target_union(spark, sf_dir):
    return tables.union_targets(*accounts(spark, sf_dir)).select("src", "entity_id", "business_name")


@query("""with u as (select 0 as src, o_custkey as k, o_orderkey as pos, cast(round(o_totalprice * 100) as bigint) as v from orders union all select 1, c_custkey, 0, c_nationkey from customer where c_nationkey < 10)
select 'K-' || k as entity_id, cast(v as bigint) as v, src from (select *, row_number() over (partition by k order by src desc, pos desc) as r from u) where r = 1""")
def last_wins(spark, sf_dir):
    """Each customer's last order (which is not the dearest); of some nations' customers a second source holds."""
    o = table(spark, sf_dir, "orders").select(F.lit(0).alias("src"), F.col("o_custkey").alias("k"), F.col("o_orderkey").cast("long").alias("at"), F.round(F.col("o_totalprice") * 100).cast("long").alias("v"))
    c = table(spark, sf_dir, "customer").where("c_nationkey < 10").select(F.lit(1).alias("src"), F.col("c_custkey").alias("k"), F.lit(0).cast("long").alias("at"), F.col("c_nationkey").cast("long").alias("v"))
    u = o.unionByName(c).select("src", "at", F.concat(F.lit("K-"), "k").alias("entity_id"), "v")
    return tables.last_wins(u, "entity_id", "src", "at").select("entity_id", "v", "src")


@query("select conv_id, unnest(list_filter(list_transform(string_split(text, ','), lambda x: " + sql_strip("x") + "), lambda x: x <> '')) as item from conversations")
def list_codec(spark, sf_dir):
    v = table(spark, sf_dir, "conversations")
    return v.select("conv_id", F.explode(text.split_ids(F.col("text"))).alias("item"))


# ---------------------------------------------------------------- blocking


@query(f"with {SQL_TEXTS} select src, id as target_id, country, unnest({sql_words('name')}) as token from t")
def token_postings(spark, sf_dir):
    _, t = text_records(spark, sf_dir)
    return blocking.postings(t)


@query(f"with {SQL_TEXTS}, tw as (select country, unnest({sql_words('name')}) as token from t) select token, country, count(*) as df from tw group by 1, 2 having count(*) < 10000")
def rare_tokens(spark, sf_dir):
    _, t = text_records(spark, sf_dir)
    return blocking.rare_tokens(t, OPTIONS)


@query(f"""with d as (select 'D-' || doc_id as id, {sql_token('text')} as name, {sql_country('lang')} as country from documents)
select id as query_id, 0 as src, min(id) over (partition by name, country) as target_id, count(*) over (partition by name, country) as links from d where name <> ''""")
def exact_name_links(spark, sf_dir):
    """Documents with equal names and countries: of each the first one's id and how many there are; the pairs of a group are not spelled out."""
    d = lifecycles.token_records(documents(spark, sf_dir))
    return blocking.exact_links(d, d.withColumn("src", F.lit(0)))


@query(f"with {SQL_TEXTS}, {sql_scores(10_000)} select query_id, src, target_id, score from scored")
def token_overlap_scores(spark, sf_dir):
    return blocking.token_scores(*text_records(spark, sf_dir), OPTIONS)


@query(f"with {SQL_TEXTS}, {sql_scores(10_000)} select query_id, src, target_id, score, rank from ranked where rank <= {K}")
def block_topk_texts(spark, sf_dir):
    return blocking.block_tokens(*text_records(spark, sf_dir), OPTIONS)


@query(f"with {PARTS_Q_T}, {sql_scores(10_000)} select query_id, src, target_id, score, rank from ranked where rank <= {K}")
def block_topk(spark, sf_dir):
    return part_candidates(spark, sf_dir)


@query(f"with {PARTS_Q_T}, {sql_scores(10_000)}, l as (select query_id, string_agg(target_id, ',' order by rank) as ids from ranked where rank <= {K} group by 1) select q.id as source1_entity_id, coalesce(ids, '') as candidate_entity_ids from q left join l on q.id = query_id")
def candidate_lists(spark, sf_dir):
    q, _ = part_records(spark, sf_dir)
    return blocking.candidate_lists(q, part_candidates(spark, sf_dir))


@query(f"with {PARTS_Q_T}, {sql_scores(10_000)} select query_id as source1_entity_id, target_id as candidate_entity_id from ranked where rank <= {K}")
def candidate_explode(spark, sf_dir):
    return tables.explode_list(candidate_lists(spark, sf_dir), "source1_entity_id", "candidate_entity_ids", "candidate_entity_id")


def _accounts_q_t() -> str:
    return f"""q as (select 'C-' || c_custkey as id, {sql_token("c_name")} as name, {sql_country("n_name")} as country from customer join nation on c_nationkey = n_nationkey),
t as (select 0 as src, 'S-' || s_suppkey as id, {sql_token("s_name")} as name, {sql_country("n_name")} as country from supplier join nation on s_nationkey = n_nationkey)"""


@query(f"with {_accounts_q_t()}, {sql_scores(10_000)} select query_id, src, target_id, score, rank from ranked where rank <= {K}")
def block_accounts(spark, sf_dir):
    c, s = accounts(spark, sf_dir)
    return blocking.block_tokens(lifecycles.token_records(c), lifecycles.token_records(s).withColumn("src", F.lit(0)), OPTIONS)


# ---------------------------------------------------------------- TF-IDF

SQL_TFIDF = f"""with {SQL_TEXTS},
qb as (select id, {sql_tfidf("body0")} as body from q),
tb as (select src, id, {sql_tfidf("body0")} as body from t),
qc as (select id, term, count(*) as tf from (select id, unnest(regexp_split_to_array(body, '[^a-z0-9_]+')) as term from qb) where length(term) >= 2 group by 1, 2),
tc as (select src, id, term, count(*) as tf from (select src, id, unnest(regexp_split_to_array(body, '[^a-z0-9_]+')) as term from tb) where length(term) >= 2 group by 1, 2, 3),
vocab as (select term, count(*) as df, sum(tf) as total from tc group by 1 having count(*) >= 2 order by total desc, term limit 100000),
n as (select count(*) as n from tb),
qr as (select id, term, (1 + ln(tf)) * (ln((1.0e0 + n) / (1.0e0 + df)) + 1.0e0) as w from qc join vocab using (term), n),
tr as (select src, id, term, (1 + ln(tf)) * (ln((1.0e0 + n) / (1.0e0 + df)) + 1.0e0) as w from tc join vocab using (term), n),
qn as (select id, sqrt(sum(w * w)) as norm from qr group by 1),
tn as (select src, id, sqrt(sum(w * w)) as norm from tr group by 1, 2),
qw as (select id, term, w / norm as w from qr join qn using (id)),
tw as (select src, id, term, w / norm as w from tr join tn using (src, id)),
cos as (select qw.id as query_id, tw.src, tw.id as target_id, round(sum(qw.w * tw.w), 6) as score from qw join tw using (term) group by 1, 2, 3),
best as (select *, row_number() over (partition by query_id order by score desc, src, target_id) as rank from cos)"""


def tfidf_records(spark, sf_dir, countries: bool = False):
    b, sources = texts(spark, sf_dir, countries)
    return lifecycles.tfidf_records(b), lifecycles.tfidf_records(tables.union_targets(*sources))


@query(SQL_TFIDF + " select src, id as target_id, term, round(w, 6) as w from tw")
def tfidf_weights(spark, sf_dir):
    _, w = blocking.tfidf_weights(*tfidf_records(spark, sf_dir))
    return w.select("src", F.col("id").alias("target_id"), "term", F.round("w", 6).alias("w"))


@query(SQL_TFIDF + f" select query_id, src, target_id, score, rank from best where rank <= {K}")
def tfidf_cosine_topk(spark, sf_dir):
    return blocking.top_k(blocking.cosine_pairs(*tfidf_records(spark, sf_dir)), K)


SQL_BLOCK_TFIDF = SQL_TFIDF + f""", nm as (select 'B-' || item_id as id, {sql_tfidf("text")} as name, (['', 'en', 'fr'])[cast(item_id % 3 + 1 as int)] as country from benchmark),
tm as (select 'D-' || doc_id as id, {sql_tfidf("text")} as name, {sql_country("lang")} as country from documents union all select 'V-' || conv_id || '.' || turn, {sql_tfidf("text")}, '' from conversations),
found as (select distinct query_id, target_id from (
  select query_id, target_id from best join nm on nm.id = query_id join tm on tm.id = target_id where rank <= {K} and (nm.country = tm.country or nm.country = '')
  union all select nm.id, tm.id from nm join tm using (name, country) where name <> ''))"""


@query(SQL_BLOCK_TFIDF + " select * from found")
def block_tfidf(spark, sf_dir):
    return blocking.block_tfidf(*tfidf_records(spark, sf_dir, countries=True), TfidfOptions(k=K))


@query(SQL_BLOCK_TFIDF + ", l as (select query_id, string_agg(target_id, ',' order by target_id) as ids from found group by 1) select nm.id as source1_entity_id, coalesce(ids, '') as candidate_entity_ids from nm left join l on nm.id = query_id")
def candidate_lists_ascending(spark, sf_dir):
    q, t = tfidf_records(spark, sf_dir, countries=True)
    return blocking.candidate_lists(q, blocking.block_tfidf(q, t, TfidfOptions(k=K)), by_rank=False)


# ---------------------------------------------------------------- features

SQL_PAIR_FEATURES = f"""pairs as (select query_id as source1_entity_id, target_id as candidate_entity_id from ranked where rank <= {K}),
raw as (select id, {sql_raw("p_name")} as name, {sql_raw("p_type")} as addr, {sql_raw("p_brand")} as country from parts),
feats as (
  select source1_entity_id, candidate_entity_id,
    cast(a.name <> '' and a.name = b.name as int) as name_exact_match,
    cast(a.addr <> '' and a.addr = b.addr as int) as addr_exact_match,
    cast(a.country <> '' and a.country = b.country as int) as country_match,
    case when a.name <> '' and b.name <> '' then round(1.0e0 - levenshtein(a.name, b.name) / cast(greatest(length(a.name), length(b.name)) as double), 6) else 0.0e0 end as name_levenshtein,
    case when a.name <> '' and b.name <> '' then round(jaro_winkler_similarity(a.name, b.name), 6) else 0.0e0 end as name_jaro_winkler,
    case when a.addr <> '' and b.addr <> '' then round(1.0e0 - levenshtein(a.addr, b.addr) / cast(greatest(length(a.addr), length(b.addr)) as double), 6) else 0.0e0 end as addr_levenshtein,
    cast(abs(length(a.name) - length(b.name)) as int) as name_length_diff,
    cast(abs(length(a.addr) - length(b.addr)) as int) as addr_length_diff
  from pairs join raw a on a.id = source1_entity_id join raw b on b.id = candidate_entity_id)"""
SQL_FEATURES = f"with {PARTS_Q_T}, {sql_scores(10_000)}, {SQL_PAIR_FEATURES}"


def part_features(spark, sf_dir):
    """Of all candidate pairs, and of pairs with an id that no source has, which have no features."""
    p, found = parts(spark, sf_dir), part_candidates(spark, sf_dir).select("query_id", "target_id")
    ids = p.select("entity_id")
    unknown = ids.select(F.col("entity_id").alias("query_id"), F.lit("P-unknown").alias("target_id")).unionByName(ids.select(F.lit("P-unknown").alias("query_id"), F.col("entity_id").alias("target_id")))
    return lifecycles.pairs_with_features(p, p, found.unionByName(unknown))


@query(SQL_FEATURES + " select * from feats")
def pair_features(spark, sf_dir):
    out = part_features(spark, sf_dir)
    return out.withColumns({c: F.round(c, 6) for c in ("name_levenshtein", "name_jaro_winkler", "addr_levenshtein")})


_NEIGHBOURS = "with n as (select p_partkey as k, p_name || ' ' || p_type as name from part) select a.k as p_partkey, a.name as a, b.name as b, {} as score from n a join n b on b.k = a.k + 1"


def _neighbours(spark, sf_dir):
    """Each part's name and type beside the next part's."""
    n = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("a"))
    return n.join(n.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("a").alias("b")), "p_partkey")


@query(_NEIGHBOURS.format("round(1.0e0 - levenshtein(a.name, b.name) / cast(greatest(length(a.name), length(b.name)) as double), 6)"))
def levenshtein_sim(spark, sf_dir):
    return _neighbours(spark, sf_dir).withColumn("score", F.round(similarity.levenshtein(F.col("a"), F.col("b")), 6))


@query(_NEIGHBOURS.format("round(jaro_winkler_similarity(a.name, b.name), 6)"))
def jaro_winkler(spark, sf_dir):
    return _neighbours(spark, sf_dir).withColumn("score", F.round(similarity.jaro_winkler(F.col("a"), F.col("b")), 6))


# ---------------------------------------------------------------- labels and evaluation
# true pairs: each part with the first of its brand that has its name and address

SQL_TRUTH = """truth as (select id as source1_entity_id, min(id) over (partition by p_name, p_type, p_brand) as entity_id from parts)"""
SQL_LABELS = f"{SQL_FEATURES}, {SQL_TRUTH}, labelled as (select feats.*, cast(entity_id is not null as int) as is_match from feats left join truth on truth.source1_entity_id = feats.source1_entity_id and entity_id = candidate_entity_id)"


def part_truth(spark, sf_dir):
    alike = Window.partitionBy("business_name", "business_address", "country")
    return parts(spark, sf_dir).select(F.col("entity_id").alias("source1_entity_id"), F.min("entity_id").over(alike).alias("entity_id"))


def part_labels(spark, sf_dir):
    return evaluate.label_pairs(part_features(spark, sf_dir), part_truth(spark, sf_dir))


def scored_pairs(spark, sf_dir):
    """The labelled pairs with a plain score in place of a model's: the mean of name and address similarity, in 0.001 steps."""
    mean = (F.col("name_levenshtein") + F.col("addr_levenshtein")) / 2
    return part_labels(spark, sf_dir).withColumn("score", F.floor(F.round(mean * 1000, 6)) / 1000)


SQL_SCORED = f"""{SQL_LABELS}, sc as (
  select *, floor(round((
    (case when a.name <> '' and b.name <> '' then 1.0e0 - levenshtein(a.name, b.name) / cast(greatest(length(a.name), length(b.name)) as double) else 0.0e0 end)
  + (case when a.addr <> '' and b.addr <> '' then 1.0e0 - levenshtein(a.addr, b.addr) / cast(greatest(length(a.addr), length(b.addr)) as double) else 0.0e0 end)) / 2 * 1000, 6)) / 1000 as score
  from labelled join raw a on a.id = source1_entity_id join raw b on b.id = candidate_entity_id)"""
SQL_CURVE = f"""{SQL_SCORED}, h as (select score as threshold, count(*) as n, sum(is_match) as pos from sc group by 1),
cum as (select threshold, sum(n) over (order by threshold desc) as m, sum(pos) over (order by threshold desc) as tp, sum(pos) over () as all_pos from h),
pr as (select threshold, tp / cast(m as double) as p, coalesce(tp / nullif(cast(all_pos as double), 0), 0.0e0) as r from cum),
curve as (select threshold, p as precision, r as recall, case when 0.25e0 * p + r > 0 then 1.25e0 * p * r / (0.25e0 * p + r) else 0.0e0 end as f05 from pr)"""


@query(SQL_LABELS + " select source1_entity_id, candidate_entity_id, is_match from labelled")
def pair_labels(spark, sf_dir):
    return part_labels(spark, sf_dir).select("source1_entity_id", "candidate_entity_id", "is_match")


@query(f"{SQL_FEATURES}, {SQL_TRUTH} select count(*) as true_pairs, count(p.source1_entity_id) as recalled, round(count(p.source1_entity_id) / cast(count(*) as double), 6) as recall from truth t left join pairs p on p.source1_entity_id = t.source1_entity_id and candidate_entity_id = entity_id")
def blocking_recall(spark, sf_dir):
    q, _ = part_records(spark, sf_dir)
    return evaluate.blocking_recall(part_candidates(spark, sf_dir), part_truth(spark, sf_dir), q).withColumn("recall", F.round("recall", 6))


@query(f"{SQL_FEATURES} select (select count(*) from q) as queries, (select count(*) from pairs) as candidates, round((select count(*) from pairs) / cast((select count(*) from q) as double), 6) as per_query")
def blocking_stats(spark, sf_dir):
    q, _ = part_records(spark, sf_dir)
    return evaluate.blocking_stats(q, part_candidates(spark, sf_dir)).withColumn("per_query", F.round("per_query", 6))


@query(SQL_LABELS + " select count(*) filter (is_match = 1) as positives, count(*) filter (is_match = 0) as negatives, round(count(*) filter (is_match = 0) / cast(greatest(count(*) filter (is_match = 1), 1) as double), 6) as weight from labelled")
def class_weights(spark, sf_dir):
    return evaluate.class_weights(part_labels(spark, sf_dir)).withColumn("weight", F.round("weight", 6))


def _rounded(curve):
    return curve.select(*[F.round(c, 6).alias(c) for c in ("threshold", "precision", "recall", "f05")])


@query(SQL_CURVE + " select round(threshold, 6) as threshold, round(precision, 6) as precision, round(recall, 6) as recall, round(f05, 6) as f05 from curve")
def pr_curve(spark, sf_dir):
    return _rounded(evaluate.pr_curve(scored_pairs(spark, sf_dir)))


@query(SQL_CURVE + " select round(threshold, 6) as threshold, round(precision, 6) as precision, round(recall, 6) as recall, round(f05, 6) as f05 from curve order by round(curve.f05, 12) desc, curve.threshold limit 1")
def best_threshold(spark, sf_dir):
    return _rounded(evaluate.best_threshold(evaluate.pr_curve(scored_pairs(spark, sf_dir))))


# ---------------------------------------------------------------- predictions

SQL_MATCHED = SQL_SCORED + ", m as (select source1_entity_id, candidate_entity_id from sc where score >= 0.9e0 and source1_entity_id <> candidate_entity_id), l as (select source1_entity_id, string_agg(candidate_entity_id, ',' order by candidate_entity_id) as ids from m group by 1), lists as (select q.id as source1_entity_id, coalesce(ids, '') as matched_entity_ids from q left join l on q.id = source1_entity_id)"


def part_matches(spark, sf_dir):
    return predict.apply_threshold(scored_pairs(spark, sf_dir), 0.9).where("source1_entity_id <> candidate_entity_id")


@query(SQL_MATCHED + " select * from lists")
def match_results(spark, sf_dir):
    return predict.match_lists(parts(spark, sf_dir), part_matches(spark, sf_dir))


@query(SQL_MATCHED + " select source1_entity_id from lists where matched_entity_ids = ''")
def singletons(spark, sf_dir):
    return predict.singletons(parts(spark, sf_dir), part_matches(spark, sf_dir))


@query(SQL_MATCHED + " select count(*) as queries, count(*) filter (matched_entity_ids <> '') as matched, cast((select count(*) from m) as bigint) as links, round(count(*) filter (matched_entity_ids <> '') / cast(count(*) as double), 6) as matched_share from lists")
def match_summary(spark, sf_dir):
    return predict.match_summary(match_results(spark, sf_dir)).withColumn("matched_share", F.round("matched_share", 6))


SQL_SIDES = SQL_LABELS + """, g as (select source1_entity_id, row_number() over (order by md5(source1_entity_id || ':42')) as place, count(*) over () as n from (select distinct source1_entity_id from labelled)),
sides as (select labelled.source1_entity_id, candidate_entity_id, is_match, case when place <= ceil(n * 0.2e0 - 1e-9) then 'test' else 'train' end as side from labelled join g using (source1_entity_id))"""


@query(SQL_SIDES + " select * from sides")
def group_split(spark, sf_dir):
    """Which side of the grouped split each labelled pair is on: exactly a fifth of the parts, rounded up, is for testing."""
    return model.with_side(part_labels(spark, sf_dir).select("source1_entity_id", "candidate_entity_id", "is_match"))


@query(SQL_SIDES + " select side, count(*) as pairs, count(*) filter (is_match = 1) as positives, round(count(*) filter (is_match = 1) / cast(count(*) as double), 6) as positive_share from sides group by 1")
def split_stats(spark, sf_dir):
    return model.split_stats(group_split(spark, sf_dir)).withColumn("positive_share", F.round("positive_share", 6))


@query()
def gbt_match(spark, sf_dir, iterations: int = 200):
    """Train on the labelled pairs, tune, and match: one list per part."""
    labelled = part_labels(spark, sf_dir).persist()
    try:
        fitted = model.train(labelled, iterations)
    finally:
        labelled.unpersist()
    return predict.match_lists(parts(spark, sf_dir), predict.apply_threshold(model.score(fitted.pipeline, part_labels(spark, sf_dir)), fitted.threshold))
