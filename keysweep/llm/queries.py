"""Queries of the operators of this folder over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keysweep.llm.bpe import bpe, bpe_digest
from keysweep.llm.conversation import repair_digest
from keysweep.llm.decontaminate import contamination, contamination_digest
from keysweep.llm.html_extract import html_extract
from keysweep.llm.language_id import language_id
from keysweep.llm.license_scan import license_digest, license_scan
from keysweep.llm.line_dedup import line_digest
from keysweep.llm.lm_score import lm_score
from keysweep.llm.merkle import merkle_digest
from keysweep.llm.quality import quality
from keysweep.llm.secret_scan import secret_digest, secret_spans
from keysweep.llm.simhash import simhash_components
from keysweep.llm.staging import table
from keysweep.llm.substring_dedup import substring_dedup


def vocabulary_path() -> str:
    """The vocabulary of the queries; it lies where the public tokenizers are installed, on the driver."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).drop("kept")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents")).drop("root")


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract(table(spark, sf_dir, "pages"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digest(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digest(bpe(table(spark, sf_dir, "documents"), vocabulary_path()))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(secret_spans(table(spark, sf_dir, "documents")))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest(license_scan(table(spark, sf_dir, "documents")))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_digest(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digest(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_simhash_near_dedup,
        op3_lm_score,
        op4_html_extraction,
        op5_line_dedup,
        op6_quality_rules,
        op7_language_id,
        op8_bpe_round_trip,
        op9_secret_scan,
        op10_benchmark_decontamination,
        op11_license_scan,
        op12_merkle_manifest,
        op13_conversation_repair,
    )
}


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text: its bits are taken in one after the other, the bytes' low bits first."""
    places = f"flatten(list_transform(string_split({text}, ''), lambda d: [ascii(d)::bigint, 0, 0, 0, 0, 0, 0, 0]))"
    step = "lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))"
    return f"xor(list_reduce(list_concat([4294967295::bigint], {places}), {step}), 4294967295)"


def added_sql(path: str, letter: str, cost: str) -> str:
    return f"{{'c': {path}.c + {cost}, 'a': {path}.a || '{letter}'}}"


def least_sql(*paths: str) -> str:
    return f"list_min([{', '.join(paths)}])"


def either_sql(condition: str, path: str) -> str:
    return f"case when {condition} then {path} else {{'c': 1000000, 'a': ''}} end"


def inserted_sql() -> str:
    """The least paths to the states e (nothing), s (system), u and a (ends in user, assistant) when rows may be inserted."""
    u = least_sql("u", *(added_sql(q, "I", "3") for q in "esa"))
    return f"e, s, {u} as u, {least_sql('a', added_sql(u, 'I', '3'))} as a"


def taken_sql() -> str:
    """The least paths after one more row, with its initial, whether it must go, and what it costs if it stays."""
    drop = {q: added_sql(q, "D", "4") for q in "esua"}
    keep = lambda q, initial: either_sql(f"not forced and initial = '{initial}'", added_sql(q, "K", "extra"))
    other = lambda q: either_sql("not forced", added_sql(q, "R", "3 + extra"))
    u = least_sql(drop["u"], *(f(q) for q in "esa" for f in (lambda q: keep(q, "u"), other)))
    return f"{drop['e']} as e, {least_sql(drop['s'], keep('e', 's'))} as s, {u} as u, {least_sql(drop['a'], keep('u', 'a'), other('u'))} as a"


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def written_sql(field: str) -> str:
    return f"coalesce(octet_length(encode({field}::varchar))::varchar || ':' || {field}::varchar, '-')"

ORACLES: dict[str, str] = {
    "op1_substring_dedup": r"""
        with texts as (
            select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words
            from documents
        ), windows as (
            select doc_id, unnest(range(1, len(words) - 18)) as s, words from texts where len(words) >= 20
        ), keyed as (
            select doc_id, s, array_to_string(words[s : s + 19], ' ') as k from windows
        ), late as (
            select doc_id, s from (select doc_id, s, row_number() over (partition by k order by doc_id, s) as n from keyed) where n > 1
        ), gone as (
            select distinct doc_id, unnest(range(s, s + 20)) as p from late
        ), numbered as (
            select doc_id, unnest(words) as w, unnest(range(1, len(words) + 1)) as p from texts
        ), kept as (
            select n.doc_id, string_agg(w, ' ' order by p) as t, count(*) as c
            from numbered n anti join gone g on n.doc_id = g.doc_id and n.p = g.p group by n.doc_id
        )
        select t.doc_id, len(words)::bigint as n_words, (len(words) - coalesce(c, 0))::bigint as n_removed,
               sha256(coalesce(k.t, '')) as kept_sha256
        from texts t left join kept k on t.doc_id = k.doc_id
    """,
    "op5_line_dedup": r"""
        with lines as (
            select doc_id, i, l, list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: w <> '') as words
            from (select doc_id, unnest(parts) as l, unnest(range(1, len(parts) + 1)) as i
                  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents))
        ), places as (
            select doc_id, i, array_to_string(words, ' ') as c, len(words) as n, words, row_number() over (order by doc_id, i) as p
            from lines where len(words) > 0
        ), classes as (
            select c, any_value(n) as n, any_value(words) as words, min(p) as p from places group by c
        ), cut as (
            select c, n, p, k, array_to_string(list_concat(words[1 : k - 1], words[k + 1 :]), ' ') as v
            from (select *, unnest(range(1, n + 1)) as k from classes where n >= 8)
        ), swapped as (
            select c, min(p) over (partition by k, v) as q from cut
        ), longer as (
            select a.c as short, b.c as long, a.p as sp, b.p as lp from classes a join cut b on a.c = b.v where a.n >= 8
        ), near as (
            select c, min(q) as q from (select c, q from swapped union all select short, lp from longer
                union all select long, sp from longer union all select c, p from classes) group by c
        ), gone as (
            select doc_id, i from places join near using (c) where p > q
        )
        select l.doc_id, count(*)::bigint as n_lines, count(g.i)::bigint as n_removed,
               sha256(coalesce(string_agg(l.l, chr(10) order by l.i) filter (where g.i is null), '')) as kept_sha256
        from lines l left join gone g on l.doc_id = g.doc_id and l.i = g.i group by l.doc_id
    """,
    "op10_benchmark_decontamination": r"""
        with item_words as (
            select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as words from benchmark
        ), wins as (
            select item_id, len(words) as n, array_to_string(words, ' ') as k from item_words where len(words) between 1 and 9
            union
            select item_id, 10, array_to_string(words[s : s + 9], ' ') from
                (select item_id, words, unnest(range(1, len(words) - 8)) as s from item_words where len(words) >= 10)
        ), texts as (
            select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as words from documents
        ), lengths as (select distinct n from wins),
        places as (
            select doc_id, n, s, array_to_string(words[s : s + n - 1], ' ') as k from
                (select doc_id, words, n, unnest(range(1, len(words) - n + 2)) as s from texts, lengths where len(words) >= n)
        ), found as (
            select p.doc_id, p.n, p.s, w.item_id from places p join wins w on p.n = w.n and p.k = w.k
        ), hit as (
            select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + n)) as p from found) group by doc_id
        ), listed as (
            select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items
            from (select distinct doc_id, item_id::varchar as item_id from found) group by doc_id
        )
        select t.doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
               sha256(coalesce(items, '')) as items_sha256, n_hit is not null as contaminated
        from texts t left join hit h on t.doc_id = h.doc_id left join listed l on t.doc_id = l.doc_id
    """,
    "op12_merkle_manifest": f"""
        with recursive leaves as (
            select doc_id, source, row_number() over (partition by source order by doc_id) - 1 as i,
                   sha256(concat({', '.join(map(written_sql, FIELDS))})) as leaf,
                   sha256(concat({', '.join(map(written_sql, FIELDS[:-1]))}, {written_sql(LOWERED)})) as changed,
                   {crc32_sql("doc_id::varchar")} % 5 = 0 as chosen
            from documents
        ), up as (
            select source, 0 as lv, i, leaf as h, count(*) over (partition by source) as n from leaves
            union all
            select source, lv, i, h, count(*) over (partition by source) as n
            from (select source, lv + 1 as lv, i // 16 as i, sha256(string_agg(h, '' order by i)) as h from up where n > 1 group by source, lv, i // 16)
        ), beside as (
            select a.source, a.lv, a.i, coalesce(string_agg(b.h, '' order by b.i) filter (where b.i < a.i), '') as before,
                   coalesce(string_agg(b.h, '' order by b.i) filter (where b.i > a.i), '') as after
            from up a join up b on a.source is not distinct from b.source and a.lv = b.lv and a.i // 16 = b.i // 16
            where a.n > 1 group by a.source, a.lv, a.i
        ), climb as (
            select doc_id, source, 0 as lv, i, case when chosen then changed else leaf end as h, '' as proof from leaves
            union all
            select c.doc_id, c.source, c.lv + 1, c.i // 16, sha256(before || h || after), proof || before || after
            from climb c join beside b on c.source is not distinct from b.source and c.lv = b.lv and c.i = b.i
        ), climbed as (
            select doc_id, source, arg_max(h, lv) as h, arg_max(proof, lv) as proof from climb group by doc_id, source
        ), subroots as (
            select source, h as subroot, row_number() over (order by source nulls first) - 1 as i from up where n = 1
        ), top as (
            select 0 as lv, i, subroot as h, count(*) over () as n from subroots
            union all
            select lv, i, h, count(*) over () as n
            from (select lv + 1 as lv, i // 16 as i, sha256(string_agg(h, '' order by i)) as h from top where n > 1 group by lv, i // 16)
        ), beside_top as (
            select a.lv, a.i, coalesce(string_agg(b.h, '' order by b.i) filter (where b.i < a.i), '') as before,
                   coalesce(string_agg(b.h, '' order by b.i) filter (where b.i > a.i), '') as after
            from top a join top b on a.lv = b.lv and a.i // 16 = b.i // 16 where a.n > 1 group by a.lv, a.i
        ), climb_top as (
            select doc_id, 0 as lv, s.i, h, proof from climbed c join subroots s on c.source is not distinct from s.source
            union all
            select c.doc_id, c.lv + 1, c.i // 16, sha256(before || h || after), proof || before || after
            from climb_top c join beside_top b on c.lv = b.lv and c.i = b.i
        ), ends as (
            select doc_id, arg_max(h, lv) as folded_root, arg_max(proof, lv) as proof from climb_top group by doc_id
        ), root as (
            select h as root from top where n = 1
        )
        select l.doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, folded_root, folded_root = root as verified
        from leaves l join subroots s on l.source is not distinct from s.source join ends e on l.doc_id = e.doc_id cross join root
    """,
    "op13_conversation_repair": rf"""
        with recursive kinds as (
            select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                   {crc32_sql("(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 as kind
            from conversations
        ), rows as (
            select conv_id, turn, case when kind = 4 then 'user' else role end as role,
                   case when kind = 1 then '' when kind = 2 then translate(text, '.!?', '') else text end as text,
                   unnest(range(case when kind = 3 then 2 else 1 end)) as copy
            from kinds where kind <> 0
        ), placed as (
            select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
                   rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as trimmed from rows
        ), judged as (
            select *, trimmed = '' as blank, trimmed <> '' and row_number() over (partition by conv_id, role, text order by i) > 1 as duplicate,
                   right(trimmed, 1) not in ('.', '!', '?') as open, left(role, 1) as initial,
                   lag(left(role, 1)) over (partition by conv_id order by i) as before
            from placed
        ), coded as (
            select conv_id, i, role, text, initial, blank or duplicate as forced, case when open then 3 else 0 end as extra from judged
        ), steps as (
            select conv_id, 0 as i, {{'c': 0, 'a': ''}} as e, {{'c': 1000000, 'a': ''}} as s, {{'c': 1000000, 'a': ''}} as u, {{'c': 1000000, 'a': ''}} as a
            from (select distinct conv_id from rows)
            union all
            select conv_id, i, {taken_sql()}
            from (select p.conv_id, n.i, n.initial, n.forced, n.extra, {inserted_sql()}
                  from steps p join coded n on p.conv_id is not distinct from n.conv_id and n.i = p.i + 1)
        ), ends as (
            select conv_id, {least_sql("e", "a")} as best
            from (select conv_id, i, {inserted_sql()} from steps) x
            where i = (select max(i) from coded c where c.conv_id is not distinct from x.conv_id)
        ), audits as (
            select conv_id, best.c as cost, best.a as audit from ends
        ), letters as (
            select conv_id, k, audit[k] as letter, len(replace(audit[1 : k], 'I', '')) as i
            from (select conv_id, audit, unnest(range(1, len(audit) + 1)) as k from audits)
        ), written as (
            select l.conv_id, k, letter, r.role, r.text, r.initial from letters l
            left join coded r on l.conv_id is not distinct from r.conv_id and l.i = r.i and l.letter <> 'I' where l.letter <> 'D'
        ), numbered as (
            select *, row_number() over (partition by conv_id order by k)
                      - max(case when letter = 'K' and initial = 's' then 1 else 0 end) over (partition by conv_id) as n from written
        ), repaired as (
            select conv_id, string_agg(case when letter = 'K' then role when n % 2 = 1 then 'user' else 'assistant' end || ':' || coalesce(text, ''),
                                       chr(10) order by k) as t
            from numbered group by conv_id
        ), counts as (
            select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
                   count(*) filter (where blank) as blank, count(*) filter (where duplicate) as duplicate,
                   count(*) filter (where open and not blank and not duplicate) as truncated,
                   count(*) filter (where before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
            from judged group by conv_id
        )
        select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
               coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost,
               coalesce(audit, '') as audit, sha256(coalesce(t, '')) as repaired_sha256
        from (select distinct conv_id from conversations) o
        left join counts c on o.conv_id is not distinct from c.conv_id
        left join audits a on o.conv_id is not distinct from a.conv_id
        left join repaired r on o.conv_id is not distinct from r.conv_id
    """,
}
