"""The queries of this package and their SQL."""

from __future__ import annotations

from tessella.llm import budget, documented, handwritten, mix, packing, spans, split, tokens
from tessella.spark_util import table


def queries() -> dict:
    """Each takes (spark, folder of tables) and works on whole tables."""
    return {
        "p1_pack": lambda s, d: packing.pack(table(s, d, "pack_item"), table(s, d, "size_limit")),
        "p1_containers": lambda s, d: packing.containers(table(s, d, "pack_item"), table(s, d, "size_limit")),
        "p1_fill": lambda s, d: packing.fill_report(table(s, d, "pack_item"), table(s, d, "size_limit")),
        "p2_found": lambda s, d: handwritten.found(table(s, d, "src_file")),
        "p2_kinds": lambda s, d: handwritten.classify(table(s, d, "src_file")),
        "p3_token_counts": lambda s, d: budget.count_documents(table(s, d, "documents")),
        "p3_budget": lambda s, d: budget.budget(table(s, d, "documents")),
        "p3_item_budget": lambda s, d: budget.item_budget(table(s, d, "pack_item")),
        "p4_found": spans.found,
        "p4_shared_parts": spans.parts,
        "p4_classes": spans.classes,
        "p4_class_links": spans.links,
        "p5_found": lambda s, d: documented.found(table(s, d, "src_file")),
        "p5_functions": lambda s, d: documented.documented_pairs(table(s, d, "src_file")),
        "p6_ids": lambda s, d: tokens.encode_documents(table(s, d, "documents"), "doc_id", "text"),
        "p7_mix": lambda s, d: mix.mix(table(s, d, "documents"), table(s, d, "mix_target"), mix.HELD),
        "p7_shares": lambda s, d: mix.mix_shares(table(s, d, "documents"), table(s, d, "mix_target"), mix.HELD),
        "p7_whole_shares": lambda s, d: mix.mix_shares(table(s, d, "documents"), table(s, d, "mix_target"), mix.HELD),
        "p7_exact_mix": lambda s, d: mix.mix(table(s, d, "documents"), table(s, d, "mix_target")),
        "p7_exact_shares": lambda s, d: mix.mix_shares(table(s, d, "documents"), table(s, d, "mix_target")),
        "p8_pieces": lambda s, d: split.split_to_limit(table(s, d, "documents"), table(s, d, "size_limit")),
    }


_RECORDS = "select distinct 'documents' as tab, doc_id as id, text as t from documents where text is not null union all select distinct 'doc_chunk', chunk_id, content from doc_chunk where content is not null"
_CLASSES = f"select tab, id, t, first_value(tab) over w as class_tab, first_value(id) over w as class_id, count(*) over (partition by t) as n_members from ({_RECORDS}) window w as (partition by t order by tab, id)"
#: Pairs of the records r that have a span of 200 characters in common.
_SHARED = """
                p as (select tab, id, t, unnest(range(1, length(t) - 198)) as i from r),
                g as (select distinct tab, id, hash(t[i:i + 199]) as h from p),
                k as (select h from g group by h having count(*) > 1),
                s as (select g.* from g join k using (h))
            select distinct a.tab as tab_a, a.id as id_a, b.tab as tab_b, b.id as id_b from s a join s b on a.h = b.h and (a.tab, a.id) < (b.tab, b.id)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p4_found": f"with r as (select * from ({_RECORDS}) where length(t) >= 200), {_SHARED}",
        "p4_class_links": f"with r as (select tab, id, t from ({_CLASSES}) where tab = class_tab and id = class_id and length(t) >= 200), {_SHARED}",
        "p4_classes": f"select tab, id, class_tab, class_id, n_members from ({_CLASSES})",
        "p3_item_budget": """
            with once as (select item_id, arg_max(struct_pack(g := coalesce(nullif(lower(trim(granularity)), ''), '(none)'),
                    size := coalesce(tokens, length(text) // 4, 0)), ingested_at) r
                from pack_item where item_id is not null group by item_id)
            select r.g as granularity, count(*) as n_rows, cast(sum(r.size) as bigint) as n_tokens from once group by 1""",
    }
