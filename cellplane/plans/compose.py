"""The product: category totals, availability, blurs and source totals from the condition bands, and its manifest."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellplane.functions.grid import GridSpec
from cellplane.operators import labels, raster, runs
from cellplane.plans.bands import BANDS, CAVEATS, GEOGRAPHY, HUMAN, NATURE, RAW, SECTIONS, catalogue, caveat_bands, derived_edges, entries, source_edges
from cellplane.plans.manifest_values import STAGES
from cellplane.scratch import materialise

SIGMAS = (100, 200, 250, 300)


def composed(conditions: dict[str, DataFrame], valid: DataFrame, grid: GridSpec, min_ha: float = 10.0) -> dict[str, DataFrame]:
    """The aggregate masks by band name. Conditions that are not given are empty. One sweep serves a total, whatever the number of its bands."""
    spark = valid.sparkSession
    none = spark.createDataFrame([], "row int, c0 int, c1 int")
    of = lambda names: {n: conditions.get(n, none) for n in names}
    some = lambda on, names: _any([on[n] for n in names])
    out = {}
    for total, names in (("exclusion_human", HUMAN), ("exclusion_nature", NATURE), ("exclusion_geography", GEOGRAPHY)):
        out[total] = materialise(runs.sweep(of(names) | {"valid": valid}, lambda on, names=names: on["valid"] & some(on, names)), total)
    out["all_exclusions"] = materialise(runs.or_(*[out[n] for n in ("exclusion_human", "exclusion_nature", "exclusion_geography")]), "all_exclusions")
    out[RAW] = materialise(runs.and_not(valid, out["all_exclusions"]), RAW)
    out[f"available_cleaned_min_{min_ha:g}ha"] = labels.min_area(out[RAW], min_ha, grid)
    return out


def blurred(raw: DataFrame, grid: GridSpec) -> dict[str, DataFrame]:
    """Percent planes of the raw availability, not clipped again."""
    cells = materialise(runs.to_cells(raw), "raw-cells")
    return {f"available_blur_sigma_{s}m": raster.blur_percent(cells, s, grid) for s in SIGMAS}


def _any(columns):
    out = columns[0]
    for c in columns[1:]:
        out = out | c
    return out


def manifest(spark: SparkSession, names: Iterable[str] = BANDS, parameters: dict | None = None, grid: GridSpec | None = None) -> str:
    """The bands as JSON: number, name, label, role, section, family, stage, buffer, sources, what each is derived from; the raster, caveats with the bands they touch, impact paths."""
    names = tuple(names)
    lists = lambda df, key, value, name: df.groupBy(F.col(key).alias("band")).agg(F.array_sort(F.collect_set(value)).alias(name))
    rows = catalogue(spark, names).join(lists(source_edges(spark), "band", "source", "quelle"), "band", "left").join(lists(derived_edges(spark, names), "dst", "src", "abgeleitet_von"), "band", "left")
    rows = rows.join(entries(spark, names).drop("nr"), "band").join(caveat_bands(spark, names).drop("nr"), "band")
    found = rows.orderBy("nr").collect()  # bounded by the number of bands
    bands = [
        {
            "index": r.nr, "name": r.band, "label_de": r.label, "category": r.section, "value_type": r.value_type, "clipped_to_austria": r.clipped, "is_total": r.total, "default_visible": r.default_visible,
            "rolle": r.role, "puffer_m": r.buffer_m, "quelle": r.quelle or [], "abgeleitet_von": r.abgeleitet_von or [], "familie": r.familie, "stufe": r.stufe, "dashboard_layer": r.dashboard_layer,
        }
        for r in found
    ]
    doc = {"band_count": len(bands), "stufe_order": list(STAGES), "category_order": [title for title, _ in SECTIONS], "bands": bands, "parameters": parameters or {}}
    doc["caveats"] = [{"id": c, "affects": {"bands": [r.nr for r in found if c in r.caveats.split(",")]}} for c in CAVEATS]
    if grid is not None:
        doc["raster"] = {"crs": grid.crs, "width": grid.width, "height": grid.height, "pixel_size_m": round(grid.cell_m, 6), "bounds": [grid.x0, grid.y_top - grid.height * grid.cell_m, grid.x0 + grid.width * grid.cell_m, grid.y_top]}
    return json.dumps(doc, ensure_ascii=False)


def header_findings(doc: dict, bands: int, width: int, height: int, crs: str) -> list[str]:
    """Where a manifest and a raster's header differ."""
    raster = doc.get("raster", {})
    pairs = (("band_count", doc.get("band_count"), bands), ("width", raster.get("width"), width), ("height", raster.get("height"), height), ("crs", raster.get("crs"), crs))
    return [f"{name}: {stated} in the manifest, {real} in the raster" for name, stated, real in pairs if stated != real]


def report(doc: dict) -> dict:
    """What a dashboard needs of a manifest: bands by role and by section, sections in order with the empty ones, findings, sizes of the impact paths."""
    short = [{k: b.get(k) for k in ("index", "name", "rolle", "category", "puffer_m")} for b in doc.get("bands", [])]
    roles: dict[str, list] = {}
    sections: dict[str, list] = {title: [] for title in doc.get("category_order", [])}
    for b in short:
        roles.setdefault(b["rolle"] or "unbekannt", []).append(b)
        sections.setdefault(b["category"] or "Sonstige", []).append(b)
    paths = {k: len(v) for k, v in doc.items() if k.endswith("_wirkungspfad") and isinstance(v, list)}
    return {"band_count": doc.get("band_count"), "by_role": roles, "by_category": sections, "findings": findings(doc), "impact_paths": paths}


def band_page(band: dict) -> str:
    """One band as a page of Markdown."""
    listed = lambda xs: "\n".join(f"- `{x}`" for x in xs) or "- keine"
    buffer = "kein Puffer" if band.get("puffer_m") is None else f"{band['puffer_m']:g} m"
    return f"# Band {band['index']}: {band.get('label_de') or band['name']}\n\n`{band['name']}` · {band.get('category')} · {band.get('rolle')} · {buffer}\n\n## Quellen\n\n{listed(band.get('quelle') or [])}\n\n## Abgeleitet von\n\n{listed(band.get('abgeleitet_von') or [])}\n"


def table_page(columns: list[str], rows: Iterable[Iterable]) -> str:
    """Rows as a table of Markdown; bars in a value are escaped."""
    line = lambda cells: "| " + " | ".join("" if c is None else str(c).replace("|", "\\|") for c in cells) + " |"
    return "\n".join([line(columns), line(["---"] * len(columns)), *(line(r) for r in rows)]) + "\n"


def findings(doc: dict) -> list[str]:
    """What is wrong with a manifest of any origin: counts, gaps, names, references to nothing."""
    bands = doc.get("bands", [])
    names, numbers, sources = [b.get("name") for b in bands], [b.get("index") for b in bands], doc.get("sources")
    out = []
    if doc.get("band_count") != len(bands):
        out.append("band_count")
    if numbers != list(range(1, len(bands) + 1)):
        out.append("index")
    if len(set(names)) < len(names):
        out.append("names repeat")
    if not all(names):
        out.append("a name is missing")
    out += [f"band {b.get('index')}: no band {d}" for b in bands for d in b.get("abgeleitet_von") or [] if d not in names]
    if sources is not None:
        out += [f"band {b.get('index')}: no source {s}" for b in bands for s in b.get("quelle") or [] if s not in sources]
    out += [f"{k}: no band {n}" for k, v in doc.items() if k.endswith("_wirkungspfad") and isinstance(v, list) for n in v if n not in names]
    out += [f"caveat {c.get('id')}: no band {i}" for c in doc.get("caveats") or [] for i in (c.get("affects") or {}).get("bands") or [] if i not in numbers]
    return out
