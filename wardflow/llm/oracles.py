"""The same results as DuckDB SQL, where SQL can state them."""

#: Windows are matched as text on whole words: the words of a document, each
#: between blanks, must contain those of the window.
OP9 = r"""
with bench as (
  select cast(item_id as varchar) item_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w
  from benchmark
), grams as (
  select distinct item_id, least(len(w), 13) size, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') gram
  from (select item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) i from bench where len(w) > 0)
), docs as (
  select row_number() over () r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w
  from documents
), spots as (
  select r, i, s.size, array_to_string(w[i:i + s.size - 1], ' ') gram
  from (select r, w, unnest(range(1, len(w) + 1)) i from docs), (select distinct size from grams) s
  where i + s.size - 1 <= len(w)
), hits as (
  select distinct r, i, g.size, item_id from spots join grams g using (size, gram)
), hit_words as (
  select r, count(distinct p) n_hit from (select r, unnest(range(i, i + size)) p from hits) group by r
), hit_items as (
  select r, count(distinct item_id) n_items, sha256(string_agg(distinct item_id, ',' order by item_id)) items_sha256 from hits group by r
)
select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  coalesce(items_sha256, sha256('')) items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from docs left join hit_words using (r) left join hit_items using (r)
"""

#: Every phrase is counted and kept as text; the sub-phrase rule is the literal one.
OP11 = r"""
with pieces as (
  select coalesce(lang, 'und') lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece
  from documents
), spoken as (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') w from pieces
), totals as (
  select lang, cast(sum(len(w)) as bigint) n from spoken group by lang
), starts as (
  select lang, w, unnest(range(1, len(w) + 1)) i from spoken
), counts as (
  select lang, size, array_to_string(w[i:i + size - 1], ' ') phrase, count(*) f
  from starts, (select unnest(range(1, 6)) size) where i + size - 1 <= len(w) group by all having count(*) >= 100
), cuts as (
  select c.lang, c.phrase, c.f a, t.n, k, l.f l, r.f r, cast(1000::hugeint * c.f * t.n // (l.f::hugeint * r.f) as bigint) score
  from (select *, unnest(range(1, size)) k, string_split(phrase, ' ') w from counts where size > 1) c
  join totals t using (lang)
  join counts l on l.lang = c.lang and l.phrase = array_to_string(w[1:k], ' ')
  join counts r on r.lang = c.lang and r.phrase = array_to_string(w[k + 1:], ' ')
), best as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), kept as (
  select * from best b where not exists (
    select 1 from counts x where x.lang = b.lang and x.size > len(string_split(b.phrase, ' ')) and 100 * x.f >= 100 * b.a and contains(' ' || x.phrase || ' ', ' ' || b.phrase || ' '))
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) "rank", phrase, a, l, r, n, score
from kept qualify "rank" <= 2000
"""

#: The checksum is computed bit by bit; costs (w: from start, system, user,
#: assistant) run backward over turn numbers, edits forward.
OP13 = r"""
with recursive coded as (
  select conv_id, turn, coalesce(role, ' ') r, coalesce(text, ' ') t,
    xor(list_reduce([4294967295::ubigint] || list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''), lambda x: ord(x)::ubigint),
      lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::ubigint) % 20 code
  from conversations
), copied as (
  select *, unnest(range(if(code = 3, 2, 1))) from coded where code <> 0
), damaged as (
  select conv_id, turn, if(code = 4, 'user', r) r, case code when 1 then '' when 2 then translate(t, '.!?', '') else t end t from copied
), numbered as (
  select *, dense_rank() over (order by conv_id nulls first) k, row_number() over (partition by conv_id order by turn nulls first, r, md5(t)) i,
    rtrim(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) body
  from damaged
), turns as (
  select *, left(r, 1) o, case when body = '' then 'b' when row_number() over (partition by k, r, t order by i) > 1 then 'd' when right(body, 1) not in ('.', '!', '?') then 't' else '' end f,
    lead(left(r, 1)) over (partition by k order by i) follows
  from numbered
), counts as (
  select k, any_value(conv_id) conv_id, count(*) n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (f = 'b') blank, count(*) filter (f = 'd') duplicate,
    count(*) filter (f = 't') truncated, count(*) filter (follows is not null and o || follows not in ('su', 'ua', 'au')) illegal
  from turns group by k
), steps as (
  select k, i, o, r, t, f in ('b', 'd') must, if(f = 't', 1, 0) more from turns
), costs as (
  select k, n + 1 i, [0, 4, 2, 0] w from counts
  union all
  select k, i, if(must, list_transform(w, lambda x: x + 3), [least(b[1], 2 + b[3], 4 + b[4]), least(b[2], 2 + b[3], 4 + b[4]), least(b[3], 2 + b[4]), least(b[4], 2 + b[3])])
  from (
    select s.k, s.i, must, w, [
      least(3 + w[1], more + least(case o when 's' then w[2] when 'u' then w[3] else 1000000000 end, 2 + w[3])),
      least(3 + w[2], more + w[3] + if(o = 'u', 0, 2)), least(3 + w[3], more + w[4] + if(o = 'a', 0, 2)), least(3 + w[4], more + w[3] + if(o = 'u', 0, 2))] b
    from costs c join steps s on s.k = c.k and s.i = c.i - 1)
), walk as (
  select k, 1::bigint i, 1 st, '' audit, []::varchar[] lines from counts
  union all
  select k, if(e = 'I', i, i + 1), case when e = 'D' then st when e = 'K' and o = 's' then 2 else nx end, audit || e,
    case e when 'D' then lines when 'K' then list_append(lines, r || ':' || t) else list_append(lines, if(nx = 3, 'user:', 'assistant:') || if(e = 'R', t, '')) end
  from (
    select p.*, s.o, s.r, s.t, if(st = 3, 4, 3) nx,
      case when s.k is null then 'I' when 3 + v.w[st] = h.w[st] then 'D' when not must and 2 + h.w[if(st = 3, 4, 3)] = h.w[st] then 'I'
        when st = 1 and o = 's' and more + v.w[2] = h.w[1] or o = if(st = 3, 'a', 'u') and more + v.w[if(st = 3, 4, 3)] = h.w[st] then 'K' else 'R' end e
    from walk p join costs h on h.k = p.k and h.i = p.i left join steps s on s.k = p.k and s.i = p.i left join costs v on v.k = p.k and v.i = p.i + 1
    where s.k is not null or st in (2, 3))
), ended as (
  select w.k, audit, lines from walk w join counts c on w.k = c.k and w.i = c.n + 1 and st in (1, 4)
), found as (
  select c.*, h.w[1] paid, audit, sha256(array_to_string(lines, chr(10))) digest from counts c join ended using (k) join costs h on h.k = c.k and h.i = 1
)
select q.conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated, coalesce(illegal, 0) illegal,
  cast(coalesce(paid, 0) as bigint) cost, coalesce(audit, '') audit, coalesce(digest, sha256('')) repaired_sha256
from (select distinct conv_id from conversations) q left join found f on f.conv_id is not distinct from q.conv_id
"""

STATEMENTS = {"op9_decontamination": OP9, "op11_phrase_collocations": OP11, "op13_conversation_repair": OP13}
