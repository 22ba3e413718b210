"""Registered queries of the operators and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dartminhash, interpolation, langid, merkle, mih, mixing, packing, reply_trees, runs, sharding, toxicity, voronoi, wrappers
from .common import fold, read_table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    grammar = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), train=lambda i: fold(i) != 0)
    out = toxicity.score(docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "text"), grammar)
    return out.select("doc_id", "held_out", "score", "predicted")


def op2_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = wrappers.extract(read_table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


def op3_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    out = interpolation.score(docs, training=fold(F.col("doc_id")) != 1)
    return out.withColumn("held_out", fold(F.col("doc_id")) == 1)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), payload="crc32")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    network = langid.fit(docs, fold(F.col("doc_id")) != 0)
    out = langid.predict(docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "text"), network)
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op6_dartminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dartminhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size")


def op7_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mih.search(read_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op8_voronoi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.join(read_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = sharding.shard(rows, 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return mixing.mix(docs.select("doc_id", "source"), full=True)


def op11_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that spells control strings, formatted and read back."""
    talk = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    spoof = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = talk.unionByName(spoof)
    out = reply_trees.chats(reply_trees.from_turns(rows, *map(F.col, ("conv_id", "turn", "role", "text"))))
    out = out.withColumn("turns", reply_trees.read_back(F.col("formatted"))).withColumn("learned", reply_trees.loss_text(F.col("formatted"), F.col("loss")))
    lines = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return out.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents by language; rows chosen by their id's crc32 present one character more."""
    docs = read_table(spark, sf_dir, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    claimed = [F.when(tampered, F.col(c) + 1).otherwise(F.col(c)) if c == "n_chars" else F.col(c) for c in fields]
    return merkle.manifest(docs, "lang", ["doc_id"], fields, claimed, keep=["doc_id"])


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in all documents, a tenth of which repeat from a place on."""
    out = runs.find_runs(read_table(spark, sf_dir, "documents"), rewrite=runs.periodic)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    out = out.withColumn("best", longest)
    length, period = F.col("best.length"), -F.col("best.period")
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.expr("best.length * 1000 div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_wrappers": op2_wrappers,
    "op3_interpolation": op3_interpolation,
    "op4_packing": op4_packing,
    "op5_language": op5_language,
    "op6_dartminhash": op6_dartminhash,
    "op7_multi_index": op7_multi_index,
    "op8_voronoi": op8_voronoi,
    "op9_sharding": op9_sharding,
    "op10_mixing": op10_mixing,
    "op11_reply_trees": op11_reply_trees,
    "op12_merkle": op12_merkle,
    "op13_runs": op13_runs,
}


def _formatted_chars(t: reply_trees.Template) -> str:
    """SQL: the length of a turn as the template writes it."""

    def escaped(c: str) -> str:
        found = [f"(len({c}) - len(replace({c}, '{x}', ''))) // {len(x)}" for x in ("\\", *t.controls)]
        return " + ".join([f"len({c})", *found])

    return f"{len(t.head + t.sep + t.end)} + {escaped('role')} + {escaped('text')}"


def _sql_field(c: str) -> str:
    """SQL: a value as a Merkle leaf hashes it."""
    return f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"


_SQL_LEAF = "sha256(" + " || ".join(_sql_field(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"
#: The tree level by level, then every row's way up it; crc32 by its table.
_MERKLE_SQL = f"""
    with recursive tab as (
        select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t
        from (select range as i from range(256))
    ), crc as (
        select doc_id as crc_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint))),
                                       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) as crc
        from (select distinct doc_id from documents), tab
    ), leaves as (
        select doc_id, lang, {_SQL_LEAF.format(n="n_chars")} as leaf,
               case when crc % 7 = 0 then {_SQL_LEAF.format(n="(n_chars + 1)")} else {_SQL_LEAF.format(n="n_chars")} end as claimed
        from documents d left join crc c on c.crc_id is not distinct from d.doc_id
    ), placed as (
        select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by lang) as n from leaves
    ), low as (
        select lang, 0 as lvl, idx, leaf as h, n from placed
        union all
        select lang, lvl + 1, idx // 2, sha256(string_agg(h, '' order by idx)), (n + 1) // 2 from low where n > 1 group by lang, lvl, idx // 2, n
    ), subroots as (
        select lang, h as subroot, lvl as height, row_number() over (order by lang nulls first) - 1 as place, count(*) over () as n from low where n = 1
    ), high as (
        select 0 as lvl, place as idx, subroot as h, n from subroots
        union all
        select lvl + 1, idx // 2, sha256(string_agg(h, '' order by idx)), (n + 1) // 2 from high where n > 1 group by lvl, idx // 2, n
    ), steps as (
        select p.doc_id, p.lang, p.idx, a.lvl as step, a.idx as sib, (p.idx >> a.lvl) as own, a.h
        from placed p join (select lang, lvl, max(n) as n from low group by lang, lvl) x on x.lang is not distinct from p.lang and x.n > 1
        left join low a on a.lang is not distinct from p.lang and a.lvl = x.lvl and a.idx = xor(p.idx >> x.lvl, 1)
        where a.lvl is not null
        union all
        select p.doc_id, p.lang, p.idx, s.height + a.lvl, a.idx, (s.place >> a.lvl), a.h
        from placed p join subroots s on s.lang is not distinct from p.lang
        join high a on a.n > 1 and a.idx = xor(s.place >> a.lvl, 1)
    ), ways as (
        select p.lang, p.idx, p.doc_id, p.leaf, p.claimed, s.subroot, r.h as root, s.height + r.lvl as steps,
               (select coalesce(string_agg(t.h, '' order by t.step), '') from steps t where t.lang is not distinct from p.lang and t.idx = p.idx) as sibs
        from placed p join subroots s on s.lang is not distinct from p.lang, (select h, lvl from high where n = 1) r
    ), fold as (
        select lang, idx, 0 as step, claimed as h, steps from ways
        union all
        select f.lang, f.idx, f.step + 1, sha256(case when t.h is null then f.h when t.sib < t.own then t.h || f.h else f.h || t.h end), f.steps
        from fold f left join steps t on t.lang is not distinct from f.lang and t.idx = f.idx and t.step = f.step
        where f.step < f.steps
    )
    select w.doc_id, w.leaf, w.subroot, w.root, sha256(w.sibs) as proof_sha256, f.h as folded_root, f.h = w.root as verified
    from ways w join fold f on f.lang is not distinct from w.lang and f.idx = w.idx and f.step = f.steps
"""
#: Exact integer scores: the join is a cross comparison in SQL.
ORACLES: dict[str, str] = {
    "op12_merkle": _MERKLE_SQL,
    "op11_reply_trees": f"""
        with rows as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        )
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
               cast(sum(case when role = 'assistant' then len(text) else 0 end) as bigint) as loss_chars,
               sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn nulls first, role, text)) as loss_sha256,
               cast(sum({_formatted_chars(reply_trees.Template())}) as bigint) as formatted_chars
        from rows group by conv_id
    """,
    "op8_voronoi": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
            from embeddings
            where embedding is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
        ), s as (
            select q.vec_id as query_id, c.vec_id, cast(list_inner_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) as score
            from v q join v c on c.vec_id <> q.vec_id
            where q.vec_id % 20 = 0
        )
        select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
        from s qualify row_number() over (partition by query_id order by score desc, vec_id) <= 20
    """,
}
