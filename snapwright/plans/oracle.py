"""DuckDB SQL that answers the registered queries on the same test tables, for checking results.

Each statement starts with the derived directory tables it needs. Arrays and times are compared as text.
"""

from __future__ import annotations

from snapwright.operators.taxonomy import DIMENSIONS, RENAMES, pair_values
from snapwright.sources.fixtures import FIXTURE_SQL, fixture_ctes

WATERMARK = "2024-01-03 00:00:00"

ELIGIBILITY = [d for d in DIMENSIONS if d != "education"]


def with_ctes(tables: list[str], steps: list[tuple[str, str]], final: str) -> str:
    parts = [fixture_ctes(*tables)] if tables else []
    parts += [f"{name} as ({text.strip()})" for name, text in steps]
    return "with " + ",\n".join(parts) + "\n" + final.strip()


def joined(column: str) -> str:
    """Array as text, NULL items spelled out."""
    return f"array_to_string([coalesce(cast(z as varchar), '<null>') for z in {column}], '|')"


def time_text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


CLASSIFIED = (
    "classified",
    f"""
select e.id, coalesce(r.canonical, e.name) as resolved_name, coalesce(b.dimension, 'other') as dimension
from fx_eligibilities e
left join (values {pair_values(RENAMES)}) r(raw, canonical) on r.raw = e.name
left join (values {pair_values(DIMENSIONS)}) b(canonical, dimension)
  on b.canonical = coalesce(r.canonical, e.name)
""",
)

ELIGIBILITY_ARRAYS = (
    "eligibility_arrays",
    "select l.service_id, "
    + ", ".join(
        f"list(c.resolved_name order by c.resolved_name nulls last) filter (where c.dimension = '{d}')"
        f" as eligibility_{d}"
        for d in DIMENSIONS
    )
    + """, list(c.resolved_name order by c.resolved_name nulls last) as eligibility_all
from fx_eligibilities_services l join classified c on c.id = l.eligibility_id group by l.service_id""",
)


def category_arrays(name: str, prefix: str, condition: str) -> tuple[str, str]:
    return (
        name,
        f"""
select l.service_id, list_sort(list(distinct c.id)) as {prefix}category_ids,
 list_concat(list_sort(list(distinct c.name) filter (where c.name is not null)),
  case when bool_or(c.name is null) then [cast(null as varchar)] else [] end) as {prefix}category_names
from fx_categories_services l join fx_categories c on c.id = l.category_id
where {condition} group by l.service_id""",
    )


CORE = category_arrays(
    "core", "", "c.id between 0 and 399 and c.id <> 202 and not (c.id between 356 and 362)"
)
WHITELABEL = category_arrays("whitelabel", "whitelabel_", "c.id between 1000001 and 1000012")

PHONES = (
    "phone_rollup",
    """
select resource_id, string_agg(number || ' (' || service_type || ')', ', ' order by id) as phone_text
from fx_phones group by resource_id""",
)
INSTRUCTIONS = (
    "instruction_rollup",
    "select service_id, string_agg(instruction, ' | ' order by id) as instructions_text"
    " from fx_instructions group by service_id",
)
DOCUMENTS = (
    "document_rollup",
    """
select l.service_id,
 string_agg(d.url || coalesce(' (' || d.description || ')', ''), ', ' order by d.id) as documents_text
from fx_documents_services l join fx_documents d on d.id = l.document_id
where d.url is not null group by l.service_id""",
)


def minutes(column: str) -> str:
    return f"cast({column} // 100 * 60 + {column} % 100 as integer)"


def clock(column: str) -> str:
    total = minutes(column)
    return (
        f"lpad(cast((({total} // 60 + 11) % 12) + 1 as varchar), 2, '0') || ':' ||"
        f" lpad(cast({total} % 60 as varchar), 2, '0') ||"
        f" case when ({total} // 60) % 24 >= 12 then ' PM' else ' AM' end"
    )


RANK = (
    "list_position(['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'], d.day)"
)
DAY_ORDER = f"order by {RANK} nulls last, d.opens_at nulls last, d.closes_at nulls last, d.day nulls last"

SCHEDULES = (
    "schedule_rollup",
    f"""
select s.id as schedule_id, s.service_id, s.resource_id, s.hours_known,
 string_agg(d.day || ' ' || {clock('d.opens_at')} || ' - ' || {clock('d.closes_at')}, ', ' {DAY_ORDER}) as hours_text,
 list({{'day': d.day, 'open_mins': {minutes('d.opens_at')}, 'close_mins': {minutes('d.closes_at')}}} {DAY_ORDER})
  as schedule,
 case when s.hours_known = false then 'Call to confirm hours.'
  else string_agg(d.day || ' ' || {clock('d.opens_at')} || ' - ' || {clock('d.closes_at')}, ', ' {DAY_ORDER}) || '.' end as said
from fx_schedules s join fx_schedule_days d on d.schedule_id = s.id
group by s.id, s.service_id, s.resource_id, s.hours_known""",
)

# -- the snapshot, from what it is --------------------------------------------------------------------
# A visit is one row of the snapshot: a service at one of its places, under one of its own schedules and one of its
# organisation's. Whatever is said belongs to an owner (a service, an organisation, an address, ...) and has a place in the
# text. A visit's text is all that its owners say, in the order of places; where two owners speak at one place, the
# visit's first choice is heard.

# The order of places and the wording.
PLACES = (
    "organisation organisation_type organisation_short organisation_long service service_short service_long program categories eligibility"
    " eligibility_tags how_to_apply required_documents fee wait_time interpretation hours location phone email website instructions related_documents"
).split()

# Table and what each of its rows says, by owner; the owner's id is the first expression.
SAYINGS = [
    (
        "organisation", "id", "fx_resources",
        {
            "organisation": "name || coalesce(', also known as ' || alternate_name, '') || '.'",
            "organisation_type": "'Organization type: ' || legal_status || '.'",
            "organisation_short": "short_description",
            "organisation_long": "long_description",
            "email": "'Email: ' || email || '.'",
            "website": "'Website: ' || website || '.'",
        },
    ),
    ("organisation", "resource_id", "phone_rollup", {"phone": "'Phone: ' || phone_text || '.'"}),
    (
        "service", "id", "{services}",
        {
            "service": "'Service: ' || coalesce(name, 'Unnamed Service') || coalesce(' (also known as ' || alternate_name || ')', '') || '.'",
            "service_short": "short_description",
            "service_long": "long_description",
            "eligibility": "'Eligibility: ' || eligibility || '.'",
            "how_to_apply": "'How to apply: ' || application_process",
            "required_documents": "'Required documents: ' || required_documents || '.'",
            "fee": "'Fee: ' || fee || '.'",
            "wait_time": "'Wait time: ' || wait_time || '.'",
            "interpretation": "'Interpretation services available: ' || interpretation_services || '.'",
            "email": "'Email: ' || email || '.'",
            "website": "'Service website: ' || url || '.'",
        },
    ),
    ("service", "service_id", "core", {"categories": "case when len(category_names) > 0 then 'Categories: ' || coalesce(array_to_string(category_names, ', '), '') || '.' end"}),
    (
        "service", "service_id", "eligibility_arrays",
        {"eligibility_tags": "case when len(eligibility_all) > 0 then 'Who this service is for: ' || coalesce(array_to_string(eligibility_all, ', '), '') || '.' end"},
    ),
    ("service", "service_id", "instruction_rollup", {"instructions": "'Instructions: ' || instructions_text || '.'"}),
    ("service", "service_id", "document_rollup", {"related_documents": "'Related documents: ' || documents_text || '.'"}),
    ("program", "id", "fx_programs", {"program": "'Program: ' || name || coalesce(' (' || alternate_name || ')', '') || coalesce('. ' || description, '') || '.'"}),
    ("address", "id", "fx_addresses", {"location": "'Location: ' || address_1 || coalesce(', ' || address_2, '') || ', ' || city || ', ' || state_province || ' ' || postal_code || '.'"}),
    ("schedule", "schedule_id", "schedule_rollup", {"hours": "'Hours: ' || said"}),
]


def said_by(owner: str, owner_id: str, table: str, texts: dict[str, str]) -> str:
    listed = ", ".join(f"{{'place': {PLACES.index(place)}, 'text': {text}}}" for place, text in texts.items())
    return f"select '{owner}' as owner, {owner_id} as owner_id, unnest([{listed}], recursive := true) from {table}"


def some_or_null(ids: str) -> str:
    """A list to unnest that gives one row, without an id, where there is none."""
    return f"case when len({ids}) > 0 then {ids} else [cast(null as bigint)] end"


def snapshot_steps(services: str = "fx_services", mark: str = "") -> list[tuple[str, str]]:
    """Steps from ``{mark}stops`` to ``{mark}snapshot`` over a table of services, after the rollups."""
    return [
        (
            f"{mark}stops",
            f"""
select s.id as service_id, s.resource_id, s.program_id, linked.service_id is not null as own_place,
 unnest({some_or_null('case when linked.service_id is null then house.ids else linked.ids end')}) as address_id,
 {some_or_null('own.ids')} as own_ids, {some_or_null('shared.ids')} as shared_ids
from {services} s semi join (select id from fx_resources where status = 1) r on r.id = s.resource_id
left join (select service_id, list(a.id) filter (where a.id is not null) as ids from fx_addresses_services l
 left join fx_addresses a on a.id = l.address_id group by service_id) linked on linked.service_id = s.id
left join (select resource_id, list(id) as ids from fx_addresses group by resource_id) house on house.resource_id = s.resource_id
left join (select service_id, list(schedule_id) as ids from schedule_rollup group by service_id) own on own.service_id = s.id
left join (select resource_id, list(schedule_id) as ids from schedule_rollup where service_id is null group by resource_id) shared
 on shared.resource_id = s.resource_id
where s.status = 1""",
        ),
        (f"{mark}plans", f"select * exclude (own_ids), unnest(own_ids) as service_schedule_id from {mark}stops"),
        (f"{mark}visits", f"select *, row_number() over () as visit from (select * exclude (shared_ids), unnest(shared_ids) as resource_schedule_id from {mark}plans)"),
        (f"{mark}sayings", " union all ".join(said_by(owner, key, table.format(services=services), texts) for owner, key, table, texts in SAYINGS)),
        (
            f"{mark}asked",
            f"""
select visit, unnest([
 {{'owner': 'service', 'owner_id': service_id, 'choice': 0}}, {{'owner': 'organisation', 'owner_id': resource_id, 'choice': 1}},
 {{'owner': 'program', 'owner_id': program_id, 'choice': 0}}, {{'owner': 'address', 'owner_id': address_id, 'choice': 0}},
 {{'owner': 'schedule', 'owner_id': service_schedule_id, 'choice': 0}}, {{'owner': 'schedule', 'owner_id': resource_schedule_id, 'choice': 1}}
], recursive := true) from {mark}visits""",
        ),
        (f"{mark}heard", f"select visit, place, arg_min(text, choice) as text from {mark}asked join {mark}sayings using (owner, owner_id) where text is not null group by visit, place"),
        (f"{mark}prose", f"select visit, trim(string_agg(text, ' ' order by place)) as embedding_text from {mark}heard group by visit"),
        (
            f"{mark}snapshot",
            "select v.service_id, v.resource_id, v.address_id, s.verified_at, s.updated_at, a.latitude, a.longitude,"
            " coalesce(own.schedule, shared.schedule) as schedule, category_ids, category_names, whitelabel_category_ids, whitelabel_category_names, "
            + ", ".join(f"eligibility_{d}" for d in [*ELIGIBILITY, "all"])
            + f", embedding_text from {mark}visits v join {mark}prose using (visit) join {services} s on s.id = v.service_id"
            " left join fx_addresses a on a.id = v.address_id left join schedule_rollup own on own.schedule_id = v.service_schedule_id"
            " left join schedule_rollup shared on shared.schedule_id = v.resource_schedule_id left join core c on c.service_id = v.service_id"
            " left join whitelabel w on w.service_id = v.service_id left join eligibility_arrays e on e.service_id = v.service_id",
        ),
    ]


ROLLUPS = [CLASSIFIED, ELIGIBILITY_ARRAYS, CORE, WHITELABEL, PHONES, INSTRUCTIONS, DOCUMENTS, SCHEDULES]
SNAPSHOT_STEPS = ROLLUPS + snapshot_steps()
SNAPSHOT_TABLES = list(FIXTURE_SQL)

ARRAY_COLUMNS = [
    "category_ids", "category_names", "whitelabel_category_ids", "whitelabel_category_names",
    *[f"eligibility_{d}" for d in ELIGIBILITY], "eligibility_all",
]


def snapshot_text_select(source: str) -> str:
    """The snapshot as plain columns: arrays and times as text, coordinates as doubles."""
    return (
        f"select service_id, resource_id, address_id, {time_text('verified_at')} as verified_at,"
        f" {time_text('updated_at')} as updated_at, cast(latitude as double) as latitude,"
        " cast(longitude as double) as longitude, cast(to_json(schedule) as varchar) as schedule, "
        + ", ".join(f"{joined(c)} as {c}" for c in ARRAY_COLUMNS)
        + f", embedding_text from {source}"
    )


def over_snapshot(final: str, extra: list[tuple[str, str]] | None = None) -> str:
    return with_ctes(SNAPSHOT_TABLES, SNAPSHOT_STEPS + (extra or []), final)


# -- embedding -------------------------------------------------------------------------------------

DIMENSION = 64


def hashed_slots(source: str, keys: list[str], text: str, name: str) -> list[tuple[str, str]]:
    """Two steps giving ``name``: one row per non-zero slot with its unit-length weight as a 4-byte float."""
    listed = ", ".join(keys)
    return [
        (
            f"{name}_counts",
            f"""
select {listed}, slot, count(*) as n from (
 select {listed}, cast(('0x' || substr(md5(token), 1, 8)) as bigint) % {DIMENSION} as slot
 from (select {listed}, unnest(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{N}}]+')) as token from {source})
 where token <> '') group by {listed}, slot""",
        ),
        (
            name,
            f"""
select {listed}, slot,
 cast(n / sqrt(cast(sum(n * n) over (partition by {listed}) as double)) as float) as weight from {name}_counts""",
        ),
    ]


# -- nearest neighbours ----------------------------------------------------------------------------

CENTROIDS = (
    "centroids",
    """
select label as query_id, list(mean order by pos) as query_vector from (
 select label, pos, avg(cast(embedding[pos] as double)) as mean
 from embeddings, generate_series(1, 64) as g(pos) group by label, pos) group by label""",
)


def ranked(vectors: str, k: int) -> list[tuple[str, str]]:
    """Exact cosine top k per centroid."""
    return [
        CENTROIDS,
        (
            "scored",
            f"""
select c.query_id, v.vec_id,
 round(list_dot_product(cast(v.embedding as double[]), c.query_vector)
  / sqrt(list_dot_product(cast(v.embedding as double[]), cast(v.embedding as double[]))
   * list_dot_product(c.query_vector, c.query_vector)), 9) as similarity
from centroids c, {vectors} v""",
        ),
        (
            "ranked",
            "select *, row_number() over (partition by query_id order by similarity desc, vec_id) as rank from scored",
        ),
    ]


RANKED_FINAL = "select query_id, vec_id, round(similarity, 4) as similarity, cast(rank as integer) as rank from ranked where rank <= {k}"


# -- one statement per registered query ------------------------------------------------------------

SNAPSHOT_MIN = with_ctes(
    ["resources", "services", "categories", "categories_services"],
    [CORE],
    f"""
select s.id as service_id, r.id as resource_id, {joined('f.category_ids')} as category_ids,
 {joined('f.category_names')} as category_names,
 trim(concat_ws(' ', r.name || '.', 'Service: ' || coalesce(s.name, 'Unnamed Service') || '.',
  {SAYINGS[3][3]['categories']})) as prose
from fx_services s join fx_resources r on r.id = s.resource_id and r.status = 1
left join core f on f.service_id = s.id where s.status = 1""",
)

PROSE_PIECES = over_snapshot(
    "select (" + str(PLACES) + ")[place + 1] as piece, text, count(*) as n from heard group by place, text"
)

TAXONOMY_REMAP = with_ctes(
    ["eligibilities", "eligibilities_services"],
    [CLASSIFIED],
    """
select e.id, e.name, c.resolved_name, count(*) as n_links from fx_eligibilities e
join classified c on c.id = e.id join fx_eligibilities_services l on l.eligibility_id = e.id
group by e.id, e.name, c.resolved_name""",
)

TAXONOMY_BUCKET = with_ctes(
    ["eligibilities", "eligibilities_services"],
    [CLASSIFIED],
    """
select c.dimension, c.resolved_name, count(*) as n_links from classified c
join fx_eligibilities_services l on l.eligibility_id = c.id group by c.dimension, c.resolved_name""",
)

CATEGORY_ROLLUP = with_ctes(
    ["categories", "categories_services"],
    [CORE],
    f"select service_id, {joined('category_ids')} as category_ids, {joined('category_names')} as category_names from core",
)

WHITELABEL_ROLLUP = with_ctes(
    ["categories", "categories_services"],
    [WHITELABEL],
    f"select service_id, {joined('whitelabel_category_ids')} as whitelabel_category_ids,"
    f" {joined('whitelabel_category_names')} as whitelabel_category_names from whitelabel",
)

ELIGIBILITY_BY_DIMENSION = with_ctes(
    ["eligibilities", "eligibilities_services"],
    [CLASSIFIED, ELIGIBILITY_ARRAYS],
    "select service_id, "
    + ", ".join(f"{joined(f'eligibility_{d}')} as eligibility_{d}" for d in [*DIMENSIONS, "all"])
    + " from eligibility_arrays",
)

PHONES_TEXT = with_ctes(["phones"], [PHONES], "select * from phone_rollup")
INSTRUCTIONS_TEXT = with_ctes(["instructions"], [INSTRUCTIONS], "select * from instruction_rollup")
DOCUMENTS_TEXT = with_ctes(["documents", "documents_services"], [DOCUMENTS], "select * from document_rollup")
SCHEDULE_ROLLUP = with_ctes(
    ["schedules", "schedule_days"],
    [SCHEDULES],
    "select schedule_id, service_id, resource_id, cast(to_json(schedule) as varchar) as schedule from schedule_rollup",
)
HOURS_TEXT = with_ctes(
    ["schedules", "schedule_days"], [SCHEDULES], "select schedule_id, hours_known, hours_text from schedule_rollup"
)

ADDRESS_FALLBACK = over_snapshot(
    """
select service_id, address_id, count(*) as n_rows, max(cast(latitude as double)) as latitude
from snapshot group by service_id, address_id"""
)
SCHEDULE_FALLBACK = over_snapshot(
    "select service_id, service_schedule_id, resource_schedule_id, count(*) as n_rows from visits group by service_id, service_schedule_id, resource_schedule_id"
)


def numbered(within: str, order: str, number: str) -> str:
    """Visits with their place in reading order; a place that the service has through its organisation only comes last."""
    order += (
        ", case when own_place then address_id end nulls last, service_schedule_id nulls last, resource_schedule_id nulls last, address_id nulls last"
    )
    return over_snapshot(
        "select resource_id, service_id, address_id, service_schedule_id, resource_schedule_id,"
        f" cast(row_number() over ({within} order by {order}) as {number}) as row_number from visits"
    )


READING_ORDER = numbered("partition by resource_id", "service_id", "integer")
READING_ORDER_GLOBAL = numbered("", "resource_id, service_id", "bigint")
HOURS_CHOICE = over_snapshot(
    f"""
select service_id, text as hours, count(*) as n_rows from visits
left join (select visit, text from heard where place = {PLACES.index('hours')}) using (visit) group by service_id, text"""
)
CONTACT_CHOICE = with_ctes(
    ["resources", "services"],
    [],
    f"""
select s.id as service_id, 'Email: ' || coalesce(s.email, r.email) || '.' as email,
 coalesce('Service website: ' || s.url || '.', 'Website: ' || r.website || '.') as website
from fx_services s join fx_resources r on r.id = s.resource_id and r.status = 1 where s.status = 1""",
)

LATER = f"updated_at > cast('{WATERMARK}' as timestamp)"

INCREMENTAL_ROWS = over_snapshot(snapshot_text_select("snapshot") + f" where snapshot.{LATER}")
DELETED_IDS = with_ctes(
    ["services"], [], f"select id as service_id from fx_services where status <> 1 and {LATER}"
)
STALE_IDS = with_ctes(
    ["services"], [], f"select id as service_id from fx_services where status is not null and {LATER}"
)

# Services before the watermark: later changes undone. The text runs in both engines.
EARLIER_SERVICES = f"""
select id, resource_id, program_id, case when {LATER} then concat('Old ', name) else name end as name,
 alternate_name, short_description, long_description, eligibility, application_process, required_documents,
 fee, wait_time, interpretation_services, email, url, case when {LATER} then 1 else status end as status,
 verified_at, case when {LATER} then null else updated_at end as updated_at from fx_services"""

MERGE_STEPS = [
    ("earlier_services", EARLIER_SERVICES),
    *snapshot_steps("earlier_services", "old_"),
    ("fresh", f"select * from snapshot where {LATER}"),
    (
        "stale",
        f"select service_id from fresh union select id from fx_services where status <> 1 and {LATER}",
    ),
    (
        "merged",
        "select * from old_snapshot where service_id not in (select service_id from stale)"
        " union all select * from fresh",
    ),
]
INCREMENTAL_MERGE = over_snapshot(snapshot_text_select("merged"), MERGE_STEPS)
PUBLISH_ROUNDTRIP = over_snapshot(
    f"""
select service_id, count(*) as n_rows, cast({DIMENSION} as integer) as dimension, max(embedding_text) as last_text
from merged group by service_id""",
    MERGE_STEPS,
)
STREAM_REFRESH = over_snapshot(
    "select service_id, count(*) as n_rows, max(embedding_text) as last_text from merged group by service_id",
    MERGE_STEPS,
)

EMBED_OFFLINE = with_ctes(
    [],
    hashed_slots("documents", ["doc_id"], "text", "slots"),
    "select doc_id, slot, round(cast(weight as double), 4) as weight from slots",
)
EMBED_DISTINCT = with_ctes(
    [],
    hashed_slots("conversations", ["conv_id", "turn"], "text", "slots"),
    "select conv_id, turn, slot, round(cast(weight as double), 4) as weight from slots",
)
EMBED_DIM_CHECK = f"select cast({DIMENSION} as integer) as dimension, count(*) as n_rows from pages"

# Vectors by text: "slot:weight" of every slot in use, weights in ten-thousandths.
TEXT_VECTORS = [
    ("texts", "select distinct embedding_text from snapshot"),
    *hashed_slots("texts", ["embedding_text"], "embedding_text", "text_slots"),
    (
        "vectors",
        "select embedding_text, string_agg(slot || ':' || cast(round(cast(weight as double) * 10000) as bigint), ',' order by slot) as vector"
        " from text_slots group by embedding_text",
    ),
]
PUBLISH_COMPACTED = over_snapshot(
    "select z.*, coalesce(vector, '') as vector from (" + snapshot_text_select("snapshot") + ") z left join vectors using (embedding_text)", TEXT_VECTORS
)
EMBED_SNAPSHOT_DISTINCT = over_snapshot(
    "select embedding_text, count(*) as n_rows, coalesce(max(vector), '') as vector from snapshot left join vectors using (embedding_text)"
    " group by embedding_text",
    TEXT_VECTORS,
)
RUN_LOG = over_snapshot(
    """
select cast(0 as bigint) as commit, count(*) as total_rows, cast(ceil(count(*) / 25.0) as bigint) as total_batches,
 cast(null as bigint) as removed_ids, 'full' as mode, 'success' as status from snapshot
union all select 1, 0, 0, null, 'incremental', 'skipped'"""
)
SEARCHED = [
    (
        "inside",
        """
select row_number() over () as row_id, embedding_text from snapshot
where latitude between 37.1 and 37.8 and longitude between -122.6 and -122.1
 and len([z for z in schedule if z.day = 'Thursday' and z.open_mins <= 945 and z.close_mins >= 945]) > 0""",
    ),
    *hashed_slots("inside", ["row_id"], "embedding_text", "row_slots"),
    *hashed_slots("benchmark", ["item_id"], "text", "query_slots"),
    (
        "products",
        """
select item_id, row_id, sum(cast(q.weight as double) * cast(r.weight as double)) as product
from query_slots q join row_slots r on r.slot = q.slot group by item_id, row_id""",
    ),
    ("row_norms", "select row_id, sqrt(sum(cast(weight as double) ** 2)) as length from row_slots group by row_id"),
    ("query_norms", "select item_id, sqrt(sum(cast(weight as double) ** 2)) as length from query_slots group by item_id"),
    (
        "found",
        """
select q.item_id as query_id, round(coalesce(product, 0) / (q.length * r.length), 9) as similarity,
 row_number() over (partition by q.item_id order by round(coalesce(product, 0) / (q.length * r.length), 9) desc) as rank
from query_norms q cross join row_norms r left join products p on p.item_id = q.item_id and p.row_id = r.row_id""",
    ),
]
SNAPSHOT_SEARCH = over_snapshot("select query_id, round(similarity, 4) as similarity, cast(rank as integer) as rank from found where rank <= 5", SEARCHED)

UNIT = (
    "unit",
    """
select vec_id, label, list_transform(embedding, lambda x: cast(x as double)
 / sqrt(list_dot_product(cast(embedding as double[]), cast(embedding as double[])))) as e from embeddings""",
)
KNN_ALL_PAIRS = with_ctes(
    [],
    [
        UNIT,
        ("scored", "select q.vec_id as query_id, v.vec_id, round(list_dot_product(q.e, v.e), 9) as similarity from unit q, unit v"),
        ("ranked", "select *, row_number() over (partition by query_id order by similarity desc, vec_id) as rank from scored"),
    ],
    RANKED_FINAL.format(k=10),
)
# Cells around the labels' mean vectors; a query looks into its four nearest cells, and into more until ten vectors are there.
KNN_APPROX = with_ctes(
    [],
    [
        UNIT, CENTROIDS,
        ("centres", "select query_id as cell, list_transform(query_vector, lambda x: x / sqrt(list_dot_product(query_vector, query_vector))) as c from centroids"),
        ("near", "select vec_id, e, cell, list_dot_product(e, c) as s from unit, centres"),
        ("nearness", "select *, row_number() over (partition by vec_id order by s desc, cell) as place from near"),
        ("placed", "select vec_id, e, cell from nearness where place = 1"),
        ("sizes", "select cell, count(p.vec_id) as n from centres left join placed p using (cell) group by cell"),
        (
            "looked",
            "select vec_id, e, cell, place, sum(n) over (partition by vec_id order by place rows between unbounded preceding and current row) - n as before"
            " from nearness join sizes using (cell)",
        ),
        (
            "scored",
            "select q.vec_id as query_id, v.vec_id, round(list_dot_product(q.e, v.e), 9) as similarity"
            " from looked q join placed v using (cell) where q.place <= 8 or q.before < 10",
        ),
        ("ranked", "select *, row_number() over (partition by query_id order by similarity desc, vec_id) as rank from scored"),
    ],
    RANKED_FINAL.format(k=10),
)

KNN_EXACT = with_ctes([], ranked("embeddings", 10), RANKED_FINAL.format(k=10))
KNN_FILTERED = with_ctes(
    [], ranked("(select * from embeddings where label = 3)", 5), RANKED_FINAL.format(k=5)
)
KNN_SINGLE = """
with mean as (select list(m order by pos) as q from (
 select pos, avg(cast(embedding[pos] as double)) as m from embeddings, generate_series(1, 64) as g(pos) group by pos)),
scored as (select vec_id, label, round(list_dot_product(cast(embedding as double[]), q)
  / sqrt(list_dot_product(cast(embedding as double[]), cast(embedding as double[])) * list_dot_product(q, q)), 9)
  as similarity from embeddings, mean)
select vec_id, label, round(similarity, 4) as similarity from scored order by scored.similarity desc, vec_id limit 10"""

ARRAY_FILTER = over_snapshot(
    """
select * from (select service_id, address_id,
 coalesce(list_contains(eligibility_age, 'Youth (below 21 years old)'), false) as member,
 coalesce(list_has_any(eligibility_health, ['Pregnant', 'Mental Illness']), false) as overlap,
 coalesce(list_has_all(eligibility_all, ['Uninsured', 'Refugees']), false) as contained from snapshot)
where member or overlap or contained"""
)
GEO_BOX = over_snapshot(
    """
select service_id, address_id, cast(latitude as double) as latitude, cast(longitude as double) as longitude
from snapshot where latitude between 37.2 and 37.6 and longitude between -122.5 and -122.1"""
)
OPEN_AT = over_snapshot(
    """
select service_id, address_id, cast(to_json(schedule) as varchar) as schedule from snapshot
where len([z for z in schedule if z.day = 'Thursday' and z.open_mins <= 945 and z.close_mins >= 945]) > 0"""
)
SERVICE_LOOKUP = over_snapshot(
    "select service_id, resource_id, address_id, embedding_text from snapshot where resource_id = 5 or service_id = 42"
)

def collection_search(source: str) -> str:
    """Five nearest documents of ``source`` (doc_id, text) for every benchmark text."""
    return with_ctes(
        [],
        hashed_slots(source, ["doc_id"], "text", "doc_slots")
        + hashed_slots("benchmark", ["item_id"], "text", "query_slots")
        + [
            ("doc_norms", "select doc_id, sqrt(sum(cast(weight as double) ** 2)) as length from doc_slots group by doc_id"),
            ("query_norms", "select item_id, sqrt(sum(cast(weight as double) ** 2)) as length from query_slots group by item_id"),
            (
                "products",
                """
    select item_id, doc_id, sum(cast(q.weight as double) * cast(d.weight as double)) as product
    from query_slots q join doc_slots d on d.slot = q.slot group by item_id, doc_id""",
            ),
            (
                "scored",
                """
    select qn.item_id as query_id, cast(dn.doc_id as varchar) as doc_id,
     round(coalesce(p.product, 0) / (qn.length * dn.length), 9) as similarity
    from query_norms qn cross join doc_norms dn
    left join products p on p.item_id = qn.item_id and p.doc_id = dn.doc_id""",
            ),
            (
                "ranked",
                "select *, row_number() over (partition by query_id order by similarity desc, doc_id) as rank from scored",
            ),
        ],
        """
    select query_id, r.doc_id, cast(rank as integer) as rank, round(similarity, 4) as similarity,
     cast(length(d.text) as integer) as length, d.source
    from ranked r join documents d on cast(d.doc_id as varchar) = r.doc_id where rank <= 5""",
    )


COLLECTION_ROUNDTRIP = collection_search("(select doc_id, text from documents where lang = 'en')")
KNN_FILTER_TYPED = collection_search("(select doc_id, text from documents join labels using (doc_id) where toxic = 1)")
COLLECTION_IDS = "select cast(doc_id % 10 as integer) as turn, cast(doc_id as varchar) as doc_id from documents"

# -- metadata --------------------------------------------------------------------------------------


def iso(column: str) -> str:
    return (
        f"strftime({column}, '%Y-%m-%dT%H:%M:%S') || case when strftime({column}, '%f') = '000000' then ''"
        f" else '.' || strftime({column}, '%f') end"
    )


METADATA_WIDE_MAPS = """
select doc_id, case when doc_id % 3 = 0 then lang end as seen_place_0, case when doc_id % 3 = 1 then lang end as seen_place_1,
 case when doc_id % 3 = 2 then lang end as seen_place_2, case when lang = 'de' then doc_id end as by_lang_de_id,
 case when lang = 'en' then doc_id end as by_lang_en_id, case when lang = 'es' then doc_id end as by_lang_es_id,
 case when lang = 'fr' then doc_id end as by_lang_fr_id from documents"""

META = (
    "meta",
    f"""
select d.doc_id, d.source as source_filename, p.url as source_url, l.quality as page_number,
 cast(d.doc_id % 5 as integer) as chunk_index, d.n_chars as token_count, l.toxic = 1 as is_toxic,
 case when d.doc_id % 7 <> 0 then 'leaflet' end as document_type, {iso('e.ts')} as extracted_date,
 case when d.doc_id % 2 = 0 then d.doc_id end as extracted_related_service_id,
 d.lang as extracted_service_type,
 case when d.doc_id % 4 <> 0 then '["' || d.source || '","' || d.lang || '"]' end as extracted_mentioned_services,
 case when d.doc_id % 3 <> 0 then 'ext. ' || d.doc_id end as extracted_contact_phone,
 case when d.doc_id % 3 <> 0 and d.doc_id % 2 = 1 then d.lang || '@example.net' end as extracted_contact_email,
 case when d.doc_id % 3 <> 0 then p.url end as extracted_contact_website,
 case when d.doc_id % 6 <> 0 then 'from 8 to 4' end as extracted_service_details_hours_weekdays,
 case when d.doc_id % 6 not in (0, 1) then 'before ' || (d.doc_id % 12) end as extracted_service_details_hours_saturday,
 case when d.doc_id % 5 = 0 then 'none' end as extracted_service_details_cost,
 '["' || d.lang || '","Welsh"]' as extracted_service_details_languages
from documents d left join labels l on l.doc_id = d.doc_id left join pages p on p.page_id = d.doc_id
left join events e on e.event_id = d.doc_id""",
)
META_KINDS = {
    "source_filename": "string", "source_url": "string", "page_number": "int", "chunk_index": "int",
    "token_count": "int", "is_toxic": "bool", "document_type": "string", "extracted_date": "string",
    "extracted_related_service_id": "int", "extracted_service_type": "string",
    "extracted_mentioned_services": "string", "extracted_contact_phone": "string",
    "extracted_contact_email": "string", "extracted_contact_website": "string",
    "extracted_service_details_hours_weekdays": "string", "extracted_service_details_hours_saturday": "string",
    "extracted_service_details_cost": "string", "extracted_service_details_languages": "string",
}
METADATA_FLAT = with_ctes([], [META], "select * from meta")
METADATA_ENTRIES = with_ctes(
    [],
    [META],
    "select * from ("
    + " union all ".join(
        f"select doc_id, '{key}' as key, cast({key} as varchar) as value, '{kind}' as value_type from meta"
        for key, kind in META_KINDS.items()
    )
    + ") where value is not null",
)


def json_object(pairs: dict[str, str]) -> str:
    """JSON text of the present pairs; values are varchar or bigint expressions."""
    items = ", ".join(f"'\"{key}\":' || cast(to_json({value}) as varchar)" for key, value in pairs.items())
    return f"nullif('{{' || array_to_string([z for z in [{items}] if z is not null], ',') || '}}', '{{}}')"


METADATA_SERIALISED = with_ctes(
    [],
    [
        META,
        (
            "inner_texts",
            "select *, "
            + json_object(
                {
                    "phone": "extracted_contact_phone", "email": "extracted_contact_email",
                    "website": "extracted_contact_website",
                }
            )
            + " as contact, "
            + json_object(
                {
                    "weekdays": "extracted_service_details_hours_weekdays",
                    "saturday": "extracted_service_details_hours_saturday",
                }
            )
            + " as hours from meta",
        ),
        (
            "details",
            "select *, "
            + json_object(
                {
                    "hours": "hours", "cost": "extracted_service_details_cost",
                    "languages": "extracted_service_details_languages",
                }
            )
            + " as service_details from inner_texts",
        ),
    ],
    "select doc_id, source_filename, source_url, page_number, chunk_index, token_count, is_toxic, document_type,"
    " extracted_date, "
    + json_object(
        {
            "related_service_id": "extracted_related_service_id", "service_type": "extracted_service_type",
            "mentioned_services": "extracted_mentioned_services", "contact": "contact",
            "service_details": "service_details",
        }
    )
    + " as extracted from details",
)
