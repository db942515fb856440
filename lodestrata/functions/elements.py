"""Typed document elements: container shapes, text rendering, section breaks.

Inside the engine an element is ``struct<kind:string, text:string>``, ``text`` being the rendered
text. A NULL ``text`` marks an element that cannot be rendered; it fails its whole document.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Element types with a meaning, their prefixes, the label before any heading.
BREAK_TYPES = ("section_header", "title")
ATOMIC_TYPES = ("table", "figure")
PREFIXES = {
    "figure": "[FIGURE] ",
    "table": "[TABLE] ",
    "title": "[TITLE] ",
    "section_header": "[SECTION_HEADER] ",
}
DEFAULT_SECTION = "Introduction"
NULL_TEXT = "None"

RENDERED_TYPE = "array<struct<kind:string,text:string>>"
ELEMENT_FIELDS = ("type", "content", "description")
TYPED_ELEMENT = "struct<" + ",".join(f"{f}:string" for f in ELEMENT_FIELDS) + ">"


def _quoted(names: tuple[str, ...]) -> str:
    return ", ".join(f"'{n}'" for n in names)


BREAK_LIST = _quoted(BREAK_TYPES)
ATOMIC_LIST = _quoted(ATOMIC_TYPES)


def is_section_break(kind: Column) -> Column:
    return F.coalesce(kind.isin(*BREAK_TYPES), F.lit(False))


def element_text(kind: Column, content: Column, description: Column) -> Column:
    """Rendered text of one typed element; a NULL content counts as a missing key (``''``)."""
    content = F.coalesce(content, F.lit(""))
    has_description = F.coalesce(description, F.lit("")) != ""
    figure = F.when(
        has_description & (content != ""),
        F.concat(F.lit(PREFIXES["figure"]), content, F.lit("\n"), description),
    ).when(has_description, F.concat(F.lit(PREFIXES["figure"]), description))
    out = F.when((kind == "figure") & has_description, figure)
    for name in ("table", *BREAK_TYPES):
        out = out.when(kind == name, F.concat(F.lit(PREFIXES[name]), content))
    return out.otherwise(content)


def render_typed(elements: Column) -> Column:
    """``array<struct<type,content,description>>`` -> rendered elements; NULL array -> empty."""
    rendered = F.transform(
        elements,
        lambda e: F.struct(
            F.coalesce(e["type"], F.lit("")).alias("kind"),
            element_text(F.coalesce(e["type"], F.lit("")), e["content"], e["description"]).alias("text"),
        ),
    )
    return F.coalesce(rendered, F.array().cast(RENDERED_TYPE))


def section_label_sql(kind: str, text: str) -> str:
    """Label of a heading: its text without any occurrence of its own prefix."""
    title, header = PREFIXES["title"], PREFIXES["section_header"]
    return f"replace({text}, IF({kind} = 'title', '{title}', '{header}'), '')"


def element_list_sql(v: str) -> str:
    """Variant ``v`` -> ``array<map<string,variant>>`` for every container shape.

    A list is taken as it is, an object with key ``elements`` gives that list, any other object
    is one element. A value of another type, or ``elements`` that is no list, gives a list that
    holds one NULL, which later fails the document. NULL stays NULL.
    """
    items = "array<map<string,variant>>"
    return (
        f"coalesce(try_variant_get({v}, '$', '{items}'), "
        f"CASE WHEN {v} IS NULL THEN NULL "
        f"WHEN map_contains_key(coalesce(try_variant_get({v}, '$', 'map<string,variant>'), map()), 'elements') "
        f"THEN coalesce(try_variant_get({v}, '$.elements', '{items}'), array(CAST(NULL AS map<string,variant>))) "
        f"ELSE array(try_variant_get({v}, '$', 'map<string,variant>')) END)"
    )


def _variant_text_sql(m: str) -> str:
    """Rendered text of one element map, NULL where the element cannot be rendered."""
    content, description = f"{m}['content']", f"{m}['description']"
    kind = f"try_variant_get({m}['type'], '$', 'string')"
    # '' when missing, NULL for JSON null or anything that is not a string
    plain = (
        f"CASE WHEN NOT map_contains_key({m}, 'content') THEN '' "
        f"WHEN schema_of_variant({content}) = 'STRING' THEN variant_get({content}, '$', 'string') END"
    )
    null_shown = f"CASE WHEN is_variant_null({content}) THEN '{NULL_TEXT}' ELSE {plain} END"
    caption = f"variant_get({description}, '$', 'string')"
    figure = (
        f"CASE WHEN coalesce(schema_of_variant({description}), 'VOID') NOT IN ('STRING', 'VOID') THEN NULL "
        f"WHEN coalesce({caption}, '') = '' THEN {plain} "
        f"WHEN is_variant_null({content}) THEN concat('{PREFIXES['figure']}', {caption}) "
        f"WHEN {plain} = '' THEN concat('{PREFIXES['figure']}', {caption}) "
        f"ELSE concat('{PREFIXES['figure']}', {plain}, '\\n', {caption}) END"
    )
    prefixed = "".join(
        f"WHEN '{name}' THEN concat('{PREFIXES[name]}', {null_shown}) "
        for name in ("table", *BREAK_TYPES)
    )
    return (
        f"CASE WHEN {m} IS NULL THEN NULL ELSE "
        f"CASE coalesce({kind}, '') WHEN 'figure' THEN {figure} {prefixed} ELSE {plain} END END"
    )


def render_variant_sql(v: str) -> str:
    """Variant -> rendered elements (empty for NULL)."""
    return (
        f"coalesce(transform({element_list_sql(v)}, m -> named_struct("
        f"'kind', coalesce(try_variant_get(m['type'], '$', 'string'), ''), "
        f"'text', {_variant_text_sql('m')})), CAST(array() AS {RENDERED_TYPE}))"
    )


def render_variant(v: str) -> Column:
    """Rendered elements of the variant column named ``v``."""
    return F.expr(render_variant_sql(v))


def render_json(json: str) -> Column:
    """Rendered elements of a JSON text column; NULL, empty or malformed text gives none."""
    return F.expr(render_variant_sql(f"try_parse_json({json})"))
