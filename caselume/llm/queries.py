"""One registered query for each operator, with production parameters on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table


def op1_token_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .sequences import new_folder, read_documents, write_sequences

    docs = table(spark, sf_dir, "documents")
    return read_documents(write_sequences(docs, new_folder(spark), public_tokenizers.path("byte_bpe_50k.json")))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), words=3, budget=2)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license import scan

    return scan(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeats import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"), least=200)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, table(spark, sf_dir, "labels"), keep=["doc_id"])


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    from .bpe import encode_documents

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN, keep_ids=False)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vectors import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"), least=0.9)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score

    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urls import judge

    return judge(table(spark, sf_dir, "pages"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .credentials import find_secrets

    return find_secrets(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .audit import audit_filters

    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .middle import digests

    return digests(table(spark, sf_dir, "documents"), seed=1)


QUERIES = {
    "op1_token_sequences": op1_token_sequences,
    "op2_simhash": op2_simhash,
    "op3_license_scan": op3_license_scan,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_decontaminate": op7_decontaminate,
    "op8_near_vectors": op8_near_vectors,
    "op9_quality": op9_quality,
    "op10_url_filter": op10_url_filter,
    "op11_secret_scan": op11_secret_scan,
    "op12_filter_audit": op12_filter_audit,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE: dict[str, str] = {
    "op12_filter_audit": """
        with texts as (
            select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
                list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') as w
            from documents
        ), marks as (
            select doc_id, max(quality) as quality, max(toxic) as toxic from labels group by doc_id
        ), masks as (
            select part, coalesce(quality = 1, false) as good, coalesce(toxic = 1, false) as toxic,
                case when len(w) < 50 then 1 else 0 end
                + case when 100 * len(list_distinct(w)) < 65 * len(w) then 2 else 0 end
                + case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 4 else 0 end
                + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
                + case when doc_id > min(doc_id) over (partition by t) then 16 else 0 end as mask
            from texts left join marks using (doc_id)
        ), counted as (
            select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from masks group by part, mask
        ), letters(l, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
        ), orders as (
            select a.l || b.l || c.l || d.l || e.l as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
            from letters a join letters b on b.l <> a.l join letters c on c.l not in (a.l, b.l) join letters d on d.l not in (a.l, b.l, c.l)
                join letters e on e.l not in (a.l, b.l, c.l, d.l)
        ), steps as (
            select filter_order, s as step, bits[s] as f, cast(coalesce(list_sum(bits[1:s - 1]), 0) as integer) as b
            from orders cross join (select unnest([1, 2, 3, 4, 5]) as s)
        ), cells as (
            select part, filter_order, step, f, coalesce(sum(n) filter (mask & (b | f) = 0), 0) as kept,
                coalesce(sum(n) filter (mask & f > 0 and mask & b = 0), 0) as removed, coalesce(sum(n) filter (mask & f > 0 and mask & b > 0), 0) as redundant,
                coalesce(sum(n) filter (mask = f), 0) as unique_fails, coalesce(sum(good) filter (mask & f > 0 and mask & b = 0), 0) as good_lost,
                coalesce(sum(toxic) filter (mask & f > 0 and mask & b = 0), 0) as toxic_lost
            from counted cross join steps group by part, filter_order, step, f
        )
        select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
            cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
            cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, f) as bigint) as shapley
        from cells""",
    "op13_fill_in_middle": """
        with texts as (
            select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as s from documents
        ), drawn as (
            select doc_id, t, cast(length(t) as bigint) as n, cast('0x' || substr(s, 1, 8) as bigint) as h1, cast('0x' || substr(s, 9, 8) as bigint) as h2,
                cast('0x' || substr(s, 17, 8) as bigint) as h3, cast('0x' || substr(s, 25, 8) as bigint) as h4
            from texts
        ), cut as (
            select *, least(h1 % (n + 1), h2 % (n + 1)) as low, greatest(h1 % (n + 1), h2 % (n + 1)) as high,
                case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
                    when h4 % 100 < 20 then 'spm' else 'psm' end as form
            from drawn
        ), parts as (
            select *, substr(t, 1, low) as p, substr(t, low + 1, high - low) as m, substr(t, high + 1) as e from cut
        )
        select doc_id, n, form, case when form <> 'plain' then low end as prefix_chars, case when form <> 'plain' then high - low end as middle_chars,
            sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || e || '<M>' || m else '<S>' || e || '<P>' || p || '<M>' || m end) as output_sha256,
            sha256(t) as restored_sha256
        from parts""",
}
