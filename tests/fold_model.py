"""What the chunk rules amount to, stated without a running state; checks the native fold.

1. A chunk ends before a heading, or before an element that would take it over the limit and is
   neither table nor figure.
2. Chunks below the minimum join the chunk before them, from the first chunk on that is large enough
   or ended at a heading; up to there every chunk stands alone.
"""

PREFIX = {"table": "[TABLE] ", "title": "[TITLE] ", "section_header": "[SECTION_HEADER] "}
HEADINGS = ("title", "section_header")
NAMES = {"heading": ("section_based", "small_section"), "limit": ("size_limited", "small_size"), "end": ("final", "small_final")}


def model_chunks(elements, max_size, min_size):
    texts = [PREFIX.get(kind, "") + content for kind, content in elements]
    sizes = [len(t) // 4 if t.strip() else 0 for t in texts]
    cuts = [0]
    why = []
    for i, (kind, _) in enumerate(elements[1:], 1):
        over = sum(sizes[cuts[-1] : i + 1]) > max_size and kind not in ("table", "figure")
        if kind in HEADINGS or over:
            cuts.append(i)
            why.append("heading" if kind in HEADINGS else "limit")
    spans = list(zip(cuts, [*cuts[1:], len(elements)], [*why, "end"])) if elements else []
    large = [sum(sizes[a:b]) >= min_size for a, b, _ in spans]
    anchor = next((i for i, (_, _, w) in enumerate(spans) if large[i] or w == "heading"), len(spans))
    heads = [i for i in range(len(spans)) if i <= anchor or large[i]]
    out = []
    for head, following in zip(heads, [*heads[1:], len(spans)]):
        first, _, reason = spans[head]
        section = next((texts[i].replace(PREFIX[elements[i][0]], "") for i in range(first, -1, -1) if elements[i][0] in HEADINGS), "Introduction")
        kind = "merged" if following - head > 1 else NAMES[reason][0 if large[head] else 1]
        out.append(("\n\n".join(texts[first : spans[following - 1][1]]), section, kind))
    return out
