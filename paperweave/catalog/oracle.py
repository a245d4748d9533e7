"""SQL with the meaning of each query, for a second engine to run."""

from __future__ import annotations

# Unicode white space, spelled out.
_WS = r"[\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _tidy(column: str) -> str:
    return f"trim(regexp_replace({column}, '{_WS}', ' ', 'g'))"


def _tokens(column: str) -> str:
    pattern = (r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
               r"|[\p{L}\p{M}]{1,4}|\p{N}{1,3}|[^\p{L}\p{M}\p{N}\p{Z}\p{C}]")
    least = f"case when {column} <> '' then 1 else 0 end"
    return f"greatest(len(regexp_extract_all({column}, '{pattern}')), {least})::bigint"


_EVENT_STATUS = (
    "case event_type when 'view' then 'in_progress' when 'click' then 'finalizing' "
    "when 'purchase' then 'completed' when 'signup' then 'validating' when 'error' then 'failed' end")
_LINE_STATUS = (
    "case l_returnflag || l_linestatus when 'AF' then 'completed' when 'AO' then 'completed' "
    "when 'NO' then 'completed' when 'NF' then 'in_progress' when 'RF' then 'expired' when 'RO' then 'failed' end")
_ORDER_STATUS = "case o_orderstatus when 'F' then 'failed' when 'O' then 'processing' when 'P' then 'pending' end"


def _fold(source: str, cap: int, key: str = "1") -> str:
    """Next-fit as a recursive walk over ``source(k, i, w)``, one step per item and key."""
    return f"""
    numbered as (select k, i, w, row_number() over (partition by k order by i) as n from ({source})),
    walk as (
        select k, i, w, n, w as filled, 1::bigint as bin from numbered where n = 1
        union all
        select t.k, t.i, t.w, t.n,
               case when f.filled + t.w > {cap} then t.w else f.filled + t.w end,
               case when f.filled + t.w > {cap} then f.bin + 1 else f.bin end
        from walk f join numbered t on t.k = f.k and t.n = f.n + 1)"""


_PACKED = "with recursive" + _fold(
    f"select 1 as k, doc_id as i, {_tokens('text')} as w from documents", 4000) + """,
    rows_ as (
        select 1::bigint as job_id, (bin - 1) // 10 + 1 as batch_id, bin as request_id,
               printf('batch-0001-%05d-request-%06d', (bin - 1) // 10 + 1, bin) as custom_id,
               row_number() over (partition by bin order by i) - 1 as pos, i as row_idx, w as token_count
        from walk)"""

_REQUESTS = _PACKED + """,
    totals as (
        select job_id, batch_id, request_id, custom_id, count(*) as text_count,
               sum(token_count)::bigint as token_count, min(row_idx) as first_row, max(row_idx) as last_row
        from rows_ group by all)"""

_LINES = _PACKED + """,
    inputs as (
        select job_id, batch_id, request_id, custom_id,
               string_agg(to_json(text)::varchar, ', ' order by row_idx) as inputs
        from rows_ join documents on doc_id = row_idx group by all),
    lines as (
        select job_id, batch_id, request_id, custom_id,
               '{"custom_id": "' || custom_id || '", "method": "POST", "url": "/v1/embeddings", "body": '
               || '{"model": "Qwen/Qwen3-Embedding-8B", "input": ['
               || inputs || ']}}' as line
        from inputs),
    sized as (select *, strlen(line) + 1 as line_bytes from lines)"""

_ROLLED = _LINES + "," + _fold("select batch_id as k, request_id as i, line_bytes as w from sized", 60000).replace(
    "numbered as", "sizes as").replace("from numbered", "from sizes").replace(
    "join numbered", "join sizes").replace("walk as", "files as").replace("from walk", "from files")

_ASKED = """
    asked as (
        select vec_id // 7 + 1 as request_id,
               printf('batch-0001-%05d-request-%06d', (vec_id // 7) // 10 + 1, vec_id // 7 + 1) as custom_id,
               vec_id % 7 as pos, vec_id, label, embedding
        from embeddings)"""

_CODED = """
    coded as (
        select vec_id, array_to_string(list_transform(embedding,
                   lambda x: case when x > 0 then '1' else '0' end), '') as bits
        from embeddings),
    words as (
        select vec_id, bits,
               (list_sum(list_transform(range(2, 65), lambda d:
                    case when bits[d] = '1' then (1::hugeint << (64 - d)::int) else 0::hugeint end))::hugeint
                - case when bits[1] = '1' then (1::hugeint << 63) else 0::hugeint end)::bigint as word
        from coded)"""

_VECTOR_MD5 = """md5(array_to_string(list_transform(embedding,
               lambda x: (round(x::double * 1000000)::bigint)::varchar), ','))"""

_FIRST_TEXTS = "select * from documents qualify row_number() over (partition by text order by doc_id) = 1"

_TOPK = """
    with q as (select label::bigint as query_id, arg_min(embedding, vec_id)::double[] as qv from embeddings group by label),
    s as (select query_id, vec_id as point_id,
                 round(list_cosine_similarity(embedding::double[], qv), 12) as s from q, embeddings),
    r as (select *, row_number() over (partition by query_id order by s desc, point_id) as rank from s)
    select query_id, rank, point_id, round(s, 6) as score from r where rank <= 10"""

_LATEST = f"""
    select user_id, event_id, {_EVENT_STATUS} as status from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"""

_JOBS = """jobs as (
    select c_custkey as id, case c_mktsegment when 'BUILDING' then 'completed'
           when 'MACHINERY' then 'paused' else 'pending' end as status, c_name as model
    from customer where c_acctbal > 0)"""
_BATCHES = """batches as (
    select o_orderkey as id, case when o_orderpriority <> '1-URGENT' then o_custkey end as job_id,
           case o_orderstatus when 'F' then 'completed' when 'O' then 'shipped' end as status,
           case when o_totalprice > 1000 then o_orderdate end as created_at
    from orders)"""

def _refreshed(newest_first: str) -> str:
    return f"""
        with last_ as (
            select user_id, event_id % 4 as part, {_EVENT_STATUS} as status from events
            qualify row_number() over (partition by user_id, event_id % 4 order by {newest_first}) = 1),
        asked as (
            select user_id, case when bool_or(status in ('cancelled', 'failed')) then 'failed'
                    when bool_or(status in ('in_progress', 'finalizing')) then 'processing'
                    when bool_and(status = 'completed') then 'completed' else 'pending' end as job_status
            from last_ group by 1)"""


_STORED = """
        select row_number() over (order by user_id, 'batch_' || user_id || '_' || part || '.jsonl') as id,
               user_id as job_id, 'batch_' || user_id || '_' || part as batch_oaid, status, job_status
        from last_ join asked using (user_id)"""


_SIDES = """
        ids as (
            select id, sum(v) as v, sum(r) as r from (
                select vec_id as id, 1 as v, 0 as r from embeddings where vec_id % 97 <> 5
                union all select vec_id, 1, 0 from embeddings where vec_id % 131 = 7
                union all select doc_id, 0, 1 from documents)
            group by id)"""

ORACLE: dict[str, str] = {
    "clean_corpus": f"""
        with kept as (
            select *, string_split(lang || ' ' || source, ' ') as parsed from documents
            where list_has_any(string_split(lang || ' ' || source, ' '), ['en', 'fr', 'src3', 'src7']))
        select doc_id, lang, source, array_to_string(parsed, ',') as categories,
               {_tidy('text')} as clean_text
        from kept qualify row_number() over (partition by text order by doc_id) = 1""",

    "clean_papers_job": f"""
        with first_ as (
            select * from documents where lang = 'en'
            qualify row_number() over (partition by doc_id // 2 order by doc_id) = 1)
        select row_number() over (order by doc_id) - 1 as row_idx, (doc_id // 2)::varchar as id,
               source || ' ' || lang as title, {_tidy('text')} as abstract,
               lang || ' ' || source || '|Jr ' || lang as authors,
               'math.CO,cs.CL,' || source as categories, null::varchar as license,
               strftime(timestamp '2007-04-02 19:18:42' + to_hours(doc_id), '%Y-%m-%d %H:%M:%S') as last_submitted
        from first_""",

    "ws_normalize": f"select doc_id, {_tidy('text')} as clean_text from documents",

    "category_filter": """
        select p_partkey, p_name, len(string_split(p_name, ' '))::bigint as n_categories from part
        where list_has_any(string_split(p_name, ' '), ['small', 'widget', 'blue'])""",

    "category_intersection": """
        select p_partkey, array_to_string(list_sort(c), ',') as common, len(c)::bigint as n_common
        from (select p_partkey, list_intersect(string_split(p_name, ' '), ['small', 'widget', 'blue']) as c from part)""",

    "dedupe_keep_first": f"select doc_id, lang, source, n_chars from ({_FIRST_TEXTS})",

    "name_reverse_join": """
        select c_custkey, trim(array_to_string(list_reverse(string_split(c_name, '#')), ' ')) as display_name
        from customer""",

    "last_version": """
        select l_orderkey, l_linenumber::bigint as l_linenumber, l_partkey, l_suppkey,
               strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as l_shipdate
        from lineitem
        qualify row_number() over (partition by l_orderkey
            order by l_linenumber desc, l_partkey desc, l_suppkey desc, l_shipdate desc) = 1""",

    "last_item": """
        select p_partkey, string_split(p_name, ' ')[-1] as last_word,
               list_filter(string_split(p_name, ' '), lambda w: w = 'ring')[-1] as last_ring
        from part""",

    "parse_http_date": """
        select o_orderkey, h as http_date,
               strftime(strptime(h, '%a, %d %b %Y %H:%M:%S GMT'), '%Y-%m-%d %H:%M:%S') as submitted
        from (select o_orderkey, strftime(o_orderdate, '%a, %-d %b %Y %H:%M:%S GMT') as h from orders)""",

    "json_fixed_schema": """
        select event_id, (props->>'k')::bigint as k, props->>'absent' as absent from events""",

    "concat_fields": "select doc_id, nullif(lang, 'en') || e'\\n\\n' || text as joined from documents",

    "token_count": f"select doc_id, {_tokens('text')} as token_count from documents",

    "tokenizer_udf": r"select doc_id, len(regexp_extract_all(text, '\S+'))::bigint as n_words from documents",

    "token_stats": f"""
        select lang, count(*) as n_texts, sum(n)::bigint as n_tokens, min(n) as least, max(n) as most
        from (select lang, {_tokens('text')} as n from documents) group by lang""",

    "row_index": "select row_number() over (order by lang, doc_id) - 1 as row_idx, lang, doc_id from documents",

    "payload_slice": """
        select row_idx, lang, doc_id, source
        from (select row_number() over (order by lang, doc_id) - 1 as row_idx, lang, doc_id, source,
                     count(*) over () as n from documents)
        where row_idx >= n // 4 and row_idx < n // 4 + n // 2""",

    "pack_requests": _PACKED + " select row_idx, token_count, request_id, pos from rows_",
    "packed_in_two_runs": _PACKED + " select row_idx, token_count, request_id, pos from rows_",
    "extended_files": _ROLLED + """
        select printf('qwen3-embedding-8b-0001-batch-%04d', k)
                   || case when bin > 1 then '_' || (bin - 1)::varchar else '' end || '.jsonl' as file_name,
               count(*) as n_lines, sum(w)::bigint as file_bytes, count(*) as n_read, sum(w)::bigint as bytes_read
        from files group by k, bin""",
    "request_manifest": _LINES + """
        select job_id, batch_id, request_id, custom_id, count(*) as text_count,
               sum(token_count)::bigint as token_count, min(row_idx) as first_row, max(row_idx) as last_row,
               any_value(line_bytes) as line_bytes
        from rows_ join sized using (job_id, batch_id, request_id, custom_id) group by all""",
    "batch_totals": _REQUESTS + """
        select job_id, batch_id, count(*) as request_count, sum(text_count)::bigint as text_count,
               sum(token_count)::bigint as token_count
        from totals group by all""",
    "request_lines": _ROLLED + """
        select request_id, custom_id, bin - 1 as file_no, md5(line) as line_md5, line_bytes
        from sized join files on k = batch_id and i = request_id""",
    "roll_files": _ROLLED + """
        select 1::bigint as job_id, k as batch_id, i as request_id, w as line_bytes, bin - 1 as file_no from files""",
    "file_totals": _ROLLED + """
        select 1::bigint as job_id, k as batch_id, bin - 1 as file_no, count(*) as request_count,
               sum(w)::bigint as file_bytes,
               printf('qwen3-embedding-8b-0001-batch-%04d', k)
                   || case when bin > 1 then '_' || (bin - 1)::varchar else '' end || '.jsonl' as file_name
        from files group by k, bin""",

    "request_files": _ROLLED + """
        select 1::bigint as job_id, k as batch_id, bin - 1 as file_no, count(*) as n_lines, sum(w)::bigint as n_bytes
        from files group by k, bin""",

    "landed_files": _ROLLED + """
        , named as (
            select printf('qwen3-embedding-8b-0001-batch-%04d', k)
                       || case when bin > 1 then '_' || (bin - 1)::varchar else '' end as stem,
                   count(*) as n_lines, sum(w)::bigint as file_bytes, count(*) filter (i % 2 = 0) as n_results
            from files group by k, bin)
        select stem || '.jsonl' as file_name, file_bytes, file_bytes as stored_bytes, n_lines,
               stem || '_result.jsonl' as result_name, n_results from named""",

    "file_names": """
        with named as (
            select o_orderkey, o_custkey,
                   'model-' || left(o_orderpriority, 1) || printf('-%04d-batch-%04d', o_custkey, o_orderkey)
                   || case when o_orderkey % 3 > 0 then '_' || (o_orderkey % 3)::varchar else '' end as stem
            from orders)
        select o_orderkey, stem || '.jsonl' as file_name,
               printf('batch-%04d-%05d-request-%06d', o_custkey, o_orderkey, o_orderkey * 100) as custom_id,
               printf('%04d', o_orderkey) as padded, 'jobs/1/' || stem || '_result.jsonl' as result_name,
               array_to_string(string_split(stem, '-')[:-3], '-') as base_name
        from named""",

    "realign_results": """
        select vec_id as vec_idx, d - 1 as dim, embedding[d]::double as x
        from embeddings, (select unnest(range(1, 65)) as d)""",

    "result_rejects": "with" + _ASKED + """
        select 'part-' || (request_id % 3)::varchar as source_file,
               count(distinct request_id) as n_lines,
               count(distinct request_id) filter (request_id % 7 = 0) as n_rejected,
               count(*) filter (request_id % 7 <> 0) as n_vectors
        from asked group by 1""",

    "reject_reasons": "with" + _ASKED + """
        select 'part-' || (request_id % 3)::varchar as source_file,
               case request_id % 4 when 1 then 'no response data' when 3 then 'item without vector'
                    else 'no custom_id or not JSON' end as reason,
               count(distinct request_id) as n_lines
        from asked where request_id % 7 = 0 group by all""",

    "unmatched_requests": "with" + _ASKED + """
        select custom_id, count(*) as n_asked, null::varchar as n_got, 'missing' as problem
        from asked where request_id % 7 = 0 group by custom_id""",

    "order_results": f"""
        select row_number() over (order by vec_id) - 1 as vec_idx, {_VECTOR_MD5} as vector_md5 from embeddings""",

    "repeated_answers": "with" + _ASKED + """
        select custom_id, case when request_id % 7 = 0 then 0 else count(*) end as n_vectors,
               case when request_id % 7 = 0 then 'missing' when request_id % 5 = 0 then 'answered twice' end as problem
        from asked group by custom_id, request_id""",

    "union_results": """
        select coalesce(part, 'all') as part, count(*) as n_vectors, sum(width)::bigint as n_values
        from (select 'low' as part, len(embedding) as width from embeddings where label < 5
              union all select 'high', len(embedding) from embeddings where label >= 5)
        group by rollup (part)""",

    "dim_violations": """
        select vec_id, r_name as model, 32::bigint as promised, len(embedding)::bigint as width
        from embeddings join region on label % 5 = r_regionkey where r_regionkey = 3""",

    "alignment_check": """
        select n_vectors, n_records, n_vectors = n_records as aligned
        from (select (select count(*) from embeddings) as n_vectors, (select count(*) from documents) as n_records)""",

    "alignment_ranges": "with" + _SIDES + """
        select id // 16 as range_no, min(id) as first_id, max(id) as last_id,
               sum(v)::bigint as n_vectors, sum(r)::bigint as n_records
        from ids group by 1 having bool_or(v <> 1 or r <> 1)""",

    "alignment_ids": "with" + _SIDES + """
        select id, v::bigint as n_vectors, r::bigint as n_records from ids where v <> 1 or r <> 1""",

    "missing_vectors": "select doc_id, lang from documents where doc_id not in (select vec_id from embeddings)",

    "orphan_vectors": f"""
        select vec_id, label::bigint as label from embeddings
        where vec_id not in (select doc_id from ({_FIRST_TEXTS}))""",

    "collection_points": f"""
        select vec_id as point_id, vec_id // 100 as chunk, len(embedding)::bigint as width,
               {_VECTOR_MD5} as vector_md5, lang, source, n_chars
        from embeddings join documents on vec_id = doc_id""",

    "collection_slice": f"""
        with kept as (select * from embeddings join documents on vec_id = doc_id),
             ids as (select max(vec_id) as largest from kept)
        select vec_id as point_id, lang, n_chars::bigint + case when vec_id % 3 = 0 then 1 else 0 end as n_chars,
               {_VECTOR_MD5} as vector_md5
        from kept, ids where vec_id >= largest // 4 and vec_id < largest // 2""",

    "collection_chunks": """
        select vec_id // 100 as chunk, min(vec_id) as start, max(vec_id) + 1 as "end", count(*) as n_rows
        from embeddings join documents on vec_id = doc_id group by 1""",

    "unit_vectors": """
        with scaled as (
            select vec_id, list_transform(embedding, lambda x: x::double * label) as v from embeddings),
        sized as (select *, sqrt(list_sum(list_transform(v, lambda x: x * x))) as size from scaled)
        select vec_id, d - 1 as dim, case when size > 0 then round(v[d] / size, 6) + 0.0 end as x
        from sized, (select unnest(range(1, 65)) as d)""",

    "binary_quantize": "with" + _CODED + " select vec_id, bits, word from words",

    "stored_vectors": f"""
        select vec_id as vec_idx, len(embedding)::bigint as width, {_VECTOR_MD5} as vector_md5
        from (select *, row_number() over (order by vec_id) - 1 as r, count(*) over () as n from embeddings)
        where r >= n // 4 and r < n // 4 + n // 2""",

    "stored_collection": "with" + _CODED + f"""
        select vec_id as point_id, lang, source, md5(text) as text_md5, word, {_VECTOR_MD5} as vector_md5,
               round((embedding[1]::double / sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))))
                     ::float::double, 5) + 0.0 as u0
        from words join embeddings using (vec_id) join documents on doc_id = vec_id""",

    "collection_upsert": "with" + _CODED + """
        select vec_id as point_id, label::bigint + case when vec_id % 2 = 0 then 100 else 0 end as label, word
        from words join embeddings using (vec_id)
        union all
        select vec_id + 1000000, label::bigint + 100, word
        from words join embeddings using (vec_id) where vec_id % 2 = 0""",

    "stream_collection_twice": "with" + _CODED + """
        select vec_id as point_id, label::bigint + case when label >= 5 then 100 else 0 end as label, word
        from words join embeddings using (vec_id)""",

    "stream_collection": "with" + _CODED + """
        select vec_id as point_id, label::bigint as label, word from words join embeddings using (vec_id)""",

    "cosine_topk": _TOPK,
    "hamming_rescore": _TOPK,
    "pivot_topk": _TOPK,

    "flatten_batch": f"""
        select event_id, 'batch_' || event_id as batch_oaid, {_EVENT_STATUS} as status,
               '/v1/embeddings' as endpoint,
               case when event_type <> 'signup' then (user_id)::varchar end as request_completed,
               case when event_type <> 'signup' then (1)::varchar end as request_failed,
               case when event_type <> 'signup' then (user_id + 1)::varchar end as request_total,
               event_type = 'error' as has_errors,
               floor(epoch(ts))::bigint as created_at,
               case when event_type = 'purchase' then (floor(epoch(ts))::bigint + 60)::varchar end as completed_at,
               (7 + case when event_type <> 'signup' then 3 else 0 end)::bigint as n_present
        from events""",

    "latest_status": _LATEST,
    "stream_latest_status": _LATEST,

    "job_status_rollup": f"""
        with asked as (
            select l_orderkey as id,
                   case when bool_or(s in ('cancelled', 'failed')) then 'failed'
                        when bool_or(s in ('in_progress', 'finalizing')) then 'processing'
                        when bool_and(coalesce(s = 'completed', false)) then 'completed' end as asked
            from (select l_orderkey, case when l_suppkey % 5 > 0 then {_LINE_STATUS} end as s from lineitem) group by 1),
        jobs as (select o_orderkey as id, {_ORDER_STATUS} as status, o_orderdate from orders)
        select jobs.id, coalesce(asked, status) as status,
               strftime(case when asked is not null and asked <> status then timestamp '2030-01-01'
                             else o_orderdate end, '%Y-%m-%d %H:%M:%S') as updated_at
        from jobs left join asked using (id)""",

    "status_sets": f"""
        select l_orderkey, string_agg(distinct s, ',' order by s) as statuses,
               bool_or(s in ('cancelled', 'failed')) as is_failing
        from (select l_orderkey, {_LINE_STATUS} as s from lineitem) group by 1""",

    "last_changed": """
        with shipped as (
            select l_orderkey as o_orderkey, max(case when l_returnflag = 'R' then l_shipdate end) as returned_at,
                   min(case when l_linestatus = 'O' then l_shipdate end) as opened_at
            from lineitem group by 1)
        select o_orderkey, strftime(greatest(
                   coalesce(case when o_orderstatus <> 'P' then o_orderdate end, timestamp '0001-01-01'),
                   coalesce(returned_at, timestamp '0001-01-01'),
                   coalesce(opened_at, timestamp '0001-01-01')), '%Y-%m-%d %H:%M:%S') as changed_at
        from orders left join shipped using (o_orderkey)""",

    "partial_upsert": """
        with last_ as (
            select * from orders
            qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1)
        select c_custkey, c_name, c_nationkey::bigint as c_nationkey,
               case when o_orderstatus in ('F', 'O') then o_totalprice else c_acctbal end as c_acctbal,
               case when o_orderstatus = 'F' then o_orderpriority
                    when o_orderstatus = 'P' then null else c_mktsegment end as c_mktsegment
        from customer left join last_ on o_custkey = c_custkey""",

    "status_report": f"""
        select event_id::varchar as id, 'batch_' || event_id as batch_oaid, {_EVENT_STATUS} as status,
               case when event_type <> 'signup' then user_id::varchar else 'None' end as completed,
               '0' as failed, user_id::varchar as total,
               case when event_type = 'error' then props else 'Null' end as errors,
               strftime(ts, '%d/%m/%Y, %H:%M:%S') as created,
               strftime(ts + interval 1 hour, '%d/%m/%Y, %H:%M:%S') as updated
        from events""",

    "job_headers": f"select o_orderkey as id, upper({_ORDER_STATUS}) as job_status from orders",

    "constraint_violations": f"""
        with {_JOBS}, {_BATCHES}
        select 'jobs' as "table", id::varchar as key, 'status is unknown' as rule from jobs where status = 'paused'
        union all select 'batches', id::varchar, 'job_id is null' from batches where job_id is null
        union all select 'batches', id::varchar, 'status is null' from batches where status is null
        union all select 'batches', id::varchar, 'status is unknown' from batches where status = 'shipped'
        union all select 'batches', id::varchar, 'created_at is null' from batches where created_at is null
        union all select 'batches', id::varchar, 'job_id has no parent' from batches
                  where job_id is not null and job_id not in (select id from jobs)""",

    "cascade_prune": f"with {_JOBS}, {_BATCHES} select id, job_id from batches where job_id in (select id from jobs)",

    "completed_only": f"""
        with {_JOBS}, {_BATCHES}
        select id, job_id from batches where job_id in (select id from jobs where status = 'completed')""",

    "job_lookup": f"""
        with {_JOBS}, {_BATCHES}
        select b.id, b.job_id, j.model, j.status as job_status from batches b join jobs j on j.id = b.job_id
        where j.id = (select max(b.job_id) from batches b join jobs j on j.id = b.job_id)""",

    "rejected_batches": f"""
        with {_JOBS}, {_BATCHES},
        known as (select id from jobs where status <> 'paused'),
        numbered as (select *, 'batch_' || id as batch_oaid, row_number() over (order by 'batch_' || id) as number from batches)
        select number as id, batch_oaid, array_to_string(list_sort(list_filter([
                   case when job_id is null then 'job_id is null' end, case when status is null then 'status is null' end,
                   case when status = 'shipped' then 'status is unknown' end,
                   case when created_at is null then 'created_at is null' end,
                   case when job_id is not null and job_id not in (select id from known) then 'job_id has no parent' end],
               lambda x: x is not null)), ', ') as rules
        from numbered""",

    "job_batches": f"""
        with {_JOBS}, {_BATCHES}
        select j.id as job_id, j.status as job_status, j.model as job_model, b.id, b.status
        from jobs j join batches b on b.job_id = j.id""",

    "stream_dedupe": "select distinct user_id, event_type from events",

    "stream_papers": "select distinct (doc_id // 2)::varchar as id from documents where lang = 'en'",

    "state_deltas": _refreshed("event_id % 7 desc, event_id desc") + _STORED,

    "rollup_by_changes": _refreshed("event_id % 7 desc, event_id desc") + """
        select user_id as job_id, status, count(*) as n, any_value(job_status) as job_status
        from last_ join asked using (user_id) group by user_id, status""",

    "stream_refresh": _refreshed("event_id desc") + _STORED,
}
