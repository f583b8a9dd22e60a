"""SQL for DuckDB that gives the rows of the registered queries."""

from __future__ import annotations

from .fixtures import IMAGES, K, ROUNDS

# name -> (names it uses, SELECT)
_PARTS: dict[str, tuple[list[str], str]] = {}
ORACLE: dict[str, str] = {}


def _part(name: str, uses: str, body: str) -> None:
    _PARTS[name] = (uses.split(), body)


def _sql(key: str, uses: str, body: str) -> None:
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for inner in _PARTS[name][0]:
                visit(inner)
            order.append(name)

    for name in uses.split():
        visit(name)
    # Parts that use parts are materialized, so that nothing is computed twice.
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({_PARTS[n][1]})" for n in order)
    ORACLE[key] = f"WITH {ctes}\n{body}" if order else body


# ---------------------------------------------------------------- derived tables

_part(
    "base",
    "",
    """SELECT vec_id AS row_id,
  concat(vec_id % 40, 'U_', vec_id % 7, 'R') AS grid_cell,
  concat('https://host/core/images/part_', lpad(CAST(vec_id // 25 AS VARCHAR), 5, '0'), '.parquet') AS parquet_url,
  vec_id % 25 AS parquet_row,
  CASE WHEN vec_id % 53 = 5 THEN NULL ELSE CAST((vec_id * 37) % 180 AS DOUBLE) - 89.5 END AS centre_lat,
  CAST((vec_id * 73) % 360 AS DOUBLE) - 179.5 AS centre_lon,
  CAST((vec_id * 13) % 101 AS DOUBLE) AS cloud_cover,
  CAST((vec_id * 29) % 64 AS DOUBLE) / 64 AS nodata
  FROM embeddings""",
)
_part(
    "manifest",
    "base",
    f"""SELECT row_id, grid_cell, parquet_url, parquet_row,
  concat('{IMAGES}/', string_split(parquet_url, '/')[-1]) AS parquet_file,
  CAST(parquet_row AS INTEGER) AS row_group, 0 AS row_in_rg FROM base""",
)
_part(
    "manifest2",
    "manifest",
    """SELECT * FROM manifest UNION ALL
  SELECT row_id + 1000000, grid_cell, parquet_url, parquet_row, replace(parquet_file, 'part_', 'absent_'), row_group, row_in_rg
  FROM manifest""",
)
_part(
    "tiles",
    "",
    """SELECT row_id, b04 AS "B04",
  list_transform(b04, lambda v: CAST(floor(v * CAST(0.8 AS DOUBLE)) AS INT)) AS "B03",
  CASE WHEN row_id % 97 = 13 THEN NULL ELSE list_concat(b04[2:64], b04[1:1]) END AS "B02"
  FROM (SELECT vec_id AS row_id, CASE WHEN vec_id % 125 = 7 THEN list_transform(range(1, 65), lambda i: CAST(0 AS INT))
    ELSE list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(greatest(x - 0.05, 0) * 30000) AS INT)) END AS b04
    FROM embeddings)""",
)
_part("whole", "tiles", 'SELECT * FROM tiles WHERE "B04" IS NOT NULL AND "B03" IS NOT NULL AND "B02" IS NOT NULL')
_part(
    "zeros",
    "whole",
    """SELECT row_id,
  len(list_filter(range(1, len("B04") + 1), lambda i: "B04"[i] = 0 AND "B03"[i] = 0 AND "B02"[i] = 0)) / CAST(len("B04") AS DOUBLE) AS nodata,
  100.0 * (len(list_filter("B04", lambda x: x = 0)) + len(list_filter("B03", lambda x: x = 0)) + len(list_filter("B02", lambda x: x = 0)))
    / CAST(len("B04") + len("B03") + len("B02") AS DOUBLE) AS zero_pct,
  list_max("B04") = 0 AND list_max("B03") = 0 AND list_max("B02") = 0 AS is_black
  FROM whole""",
)
_part(
    "wide",
    "whole",
    """SELECT row_id, 'B04' AS band, 0 AS channel, "B04" AS v FROM whole UNION ALL
  SELECT row_id, 'B03', 1, "B03" FROM whole UNION ALL SELECT row_id, 'B02', 2, "B02" FROM whole""",
)
_part(
    "scaled",
    "",
    """SELECT vec_id AS row_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * (1 + vec_id % 5)) AS v FROM embeddings
  UNION ALL SELECT vec_id + 1000000, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(0 AS DOUBLE)) FROM embeddings""",
)
_part("raw", "", "SELECT vec_id AS row_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings")
_part(
    "p",
    "raw",
    """SELECT row_id, CASE WHEN n = 0 THEN v ELSE list_transform(v, lambda x: x / n) END AS v
  FROM (SELECT row_id, v, sqrt(list_sum(list_transform(v, lambda y: y * y))) AS n FROM raw)""",
)


def _nearest(points: str, centres: str) -> str:
    return f"""SELECT row_id, cid, d2 FROM (SELECT q.row_id, c.cid, pow(list_distance(q.v, c.v), 2) AS d2,
  row_number() OVER (PARTITION BY q.row_id ORDER BY pow(list_distance(q.v, c.v), 2), c.cid) AS rn
  FROM {points} q CROSS JOIN {centres} c) WHERE rn = 1"""


def _means(assign: str, old: str, points: str = "p", dims: int = 64) -> str:
    return f"""SELECT o.cid, coalesce(m.v, o.v) AS v FROM {old} o LEFT JOIN
  (SELECT cid, list(m ORDER BY i) AS v FROM (SELECT a.cid, t.i, avg(q.v[t.i]) AS m
    FROM {assign} a JOIN {points} q USING (row_id), (SELECT unnest(range(1, {dims + 1})) AS i) t GROUP BY a.cid, t.i) GROUP BY cid) m
  ON m.cid = o.cid"""


_part(
    "c0",
    "p",
    f"SELECT CAST(rn - 1 AS INTEGER) AS cid, v FROM (SELECT v, row_number() OVER (ORDER BY row_id) AS rn FROM p) WHERE rn <= {K}",
)
for _i in range(ROUNDS):
    _part(f"a{_i}", f"p c{_i}", _nearest("p", f"c{_i}"))
    _part(f"c{_i + 1}", f"p a{_i} c{_i}", _means(f"a{_i}", f"c{_i}"))
_part("cents", f"c{ROUNDS}", f"SELECT cid, v FROM c{ROUNDS}")
_part("assign", "p cents", _nearest("p", "cents"))
_part(
    "ranked",
    "assign",
    "SELECT row_id, cid, d2, row_number() OVER (PARTITION BY cid ORDER BY d2, row_id) AS rn, count(*) OVER (PARTITION BY cid) AS n FROM assign",
)
_part("chosen", "ranked", "SELECT row_id, cid, d2 FROM ranked WHERE rn = 1")
_part("chosen20", "ranked", "SELECT row_id, cid, d2 FROM ranked WHERE rn <= 20")


def _counts(k: int) -> str:
    return f"""SELECT CAST(g.i AS INTEGER) AS cid, count(a.row_id) AS n
  FROM (SELECT unnest(range(0, {k})) AS i) g LEFT JOIN assign a ON a.cid = g.i GROUP BY g.i"""


_part("counts", "assign", _counts(K))
_part("counts12", "assign", _counts(K + 2))
_part("ranks", "counts", "SELECT cid, n, row_number() OVER (ORDER BY n DESC, cid) - 1 AS r FROM counts")
_part("ranks12", "counts12", "SELECT cid, n, row_number() OVER (ORDER BY n DESC, cid) - 1 AS r FROM counts12")
_part(
    "black",
    "raw zeros",
    """SELECT v FROM raw WHERE row_id = (SELECT row_id FROM
  (SELECT * FROM zeros ORDER BY md5(concat_ws('-', CAST(row_id AS VARCHAR), '42')), row_id LIMIT 5000)
  WHERE is_black ORDER BY md5(concat_ws('-', CAST(row_id AS VARCHAR), '42')), row_id LIMIT 1)""",
)
_part(
    "sims",
    "cents black",
    """SELECT cid, list_inner_product(c.v, b.v) / sqrt(list_inner_product(b.v, b.v)) AS s,
  list_inner_product(c.v, b.v) / ((sqrt(list_inner_product(c.v, c.v)) + 1e-8) * (sqrt(list_inner_product(b.v, b.v)) + 1e-8)) AS s2
  FROM cents c CROSS JOIN black b""",
)
_part("garbage", "sims", "SELECT cid FROM sims WHERE s > 0.02")
_part("split", "assign garbage", "SELECT row_id, cid, cid IN (SELECT cid FROM garbage) AS is_garbage FROM assign")
_part(
    "labelled",
    "split zeros",
    """SELECT s.row_id, s.cid, s.is_garbage, z.zero_pct FROM (SELECT *, row_number() OVER (PARTITION BY is_garbage
  ORDER BY md5(concat_ws('-', CAST(row_id AS VARCHAR), '42')), row_id) AS rn FROM split) s JOIN zeros z USING (row_id)
  WHERE s.rn <= CASE WHEN s.is_garbage THEN 500 ELSE 1000 END""",
)
_part(
    "sizes",
    "",
    """SELECT CAST(c_custkey AS BIGINT) AS cluster_id, count(o_orderkey) AS n_candidates FROM customer
  LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' GROUP BY c_custkey
  UNION ALL SELECT CAST(10000000 + l_linenumber AS BIGINT), count(*) FROM lineitem GROUP BY l_linenumber
  UNION ALL SELECT CAST(20000000 + l_suppkey AS BIGINT), count(*) FROM lineitem GROUP BY l_suppkey""",
)
_part(
    "pairs",
    "raw",
    "SELECT list_distance(a.v, b.v) AS d FROM raw a JOIN raw b ON a.row_id <> b.row_id WHERE list_distance(a.v, b.v) > 0",
)


def _shuffled(seed: int = 42) -> str:
    return f"md5(concat_ws('-', CAST(row_id AS VARCHAR), '{seed}')), row_id"


def _list(ids: str, source: str, col: str, value: str = "{x}") -> str:
    """Long form of a list column; {value} may rewrite an element."""
    element = value.format(x=f"{col}[t.i]")
    return (
        f"SELECT {ids}, CAST(t.i - 1 AS INTEGER) AS pos, round(CAST({element} AS DOUBLE), 6) + 0.0 AS value "
        f"FROM {source}, (SELECT unnest(range(1, 65)) AS i) t"
    )


def _text(ids: str, source: str, value: str = "{b}") -> str:
    cols = ", ".join(
        f"array_to_string({value.format(b=chr(34) + b + chr(34))}, ',') AS {b.lower()}" for b in ("B04", "B03", "B02")
    )
    return f"SELECT {ids}, {cols} FROM {source}"


# ---------------------------------------------------------------- sources and sinks

_sql("read_metadata", "base", "SELECT grid_cell, parquet_url, parquet_row FROM base")
_sql("build_manifest", "manifest", "SELECT * FROM manifest")
_sql(
    "build_manifest_images_split",
    "manifest",
    f"SELECT * REPLACE (concat('{IMAGES}/', string_split(parquet_url, 'images/')[2]) AS parquet_file) FROM manifest",
)
_sql("load_or_build_manifest", "manifest", "SELECT grid_cell, parquet_file, row_group, row_in_rg FROM manifest")
_sql(
    "read_tiles",
    "base tiles",
    _text("row_id, string_split(parquet_url, '/')[-1] AS shard, parquet_row AS row_in_file", "base JOIN tiles USING (row_id)"),
)
_sql("read_embeddings", "raw", _list("row_id", "raw", "v"))
_sql("read_centroids", "cents counts", _list("cluster_id, n", "(SELECT cid AS cluster_id, n, v FROM cents JOIN counts USING (cid))", "v"))
_sql("count_centroids", "cents", "SELECT count(*) AS n_centroids FROM cents")
_sql(
    "write_subset_manifest",
    "manifest chosen",
    "SELECT m.row_id, grid_cell, parquet_file, row_group, row_in_rg, c.cid AS cluster_id FROM manifest m JOIN chosen c USING (row_id)",
)
_STATS = """SELECT c.cid AS cluster_id, c.n AS n_candidates, CAST(CASE WHEN c.n > 0 THEN 1 ELSE 0 END AS BIGINT) AS n_sampled
FROM counts12 c"""
_sql("write_cluster_stats", "counts12", _STATS)
_sql("write_cluster_ids", "sizes", "SELECT CAST(cluster_id AS VARCHAR) AS value FROM sizes WHERE n_candidates > 99")
_sql(
    "write_labelled_sample_csv",
    "labelled",
    "SELECT row_id AS idx, cid AS cluster, is_garbage, round(zero_pct, 6) + 0.0 AS black_pct FROM labelled",
)

# ---------------------------------------------------------------- tiles

_sql(
    "band_columns",
    "wide",
    "SELECT row_id, channel, band, len(v) AS n_pixels, CAST(list_sum(v) AS BIGINT) AS total FROM wide",
)
_sql("decode_raw_band", "tiles", _text("row_id", "tiles"))
_sql("null_band_policy_drop", "whole", _text("row_id", "whole"))
_sql(
    "null_band_policy_zeros",
    "tiles",
    _text("row_id", "tiles", "coalesce({b}, list_transform(range(1, 65), lambda i: CAST(0 AS INT)))"),
)
_sql("nodata_fraction", "zeros", "SELECT row_id, round(nodata, 6) + 0.0 AS nodata FROM zeros")
_sql("zero_value_pct", "zeros", "SELECT row_id, round(zero_pct, 6) + 0.0 AS zero_pct FROM zeros")
_sql("filter_nodata", "zeros", "SELECT row_id FROM zeros WHERE NOT (nodata * 100 > 45)")
_CLAMP = "least(greatest(CAST({x} AS DOUBLE) / 10000, 0), 1)"
_sql("scale_clamp", "wide", _list("row_id, band", "wide", "v", _CLAMP))
for _name, _size in (("cubic", 5), ("cubic6", 6)):
    _part(
        _name,
        "",
        f"""SELECT i, s, sum(w) AS w FROM (SELECT i, least(greatest(b + tap, 0), 7) AS s,
    CASE WHEN t <= 1 THEN 1.25 * t * t * t - 2.25 * t * t + 1 WHEN t < 2 THEN -0.75 * t * t * t + 3.75 * t * t - 6 * t + 3 ELSE 0 END AS w
    FROM (SELECT i, tap, b, abs(c - (b + tap)) AS t FROM (SELECT i, c, CAST(floor(c) AS INTEGER) AS b FROM
      (SELECT i, (i + CAST(0.5 AS DOUBLE)) * 8 / {_size} - 0.5 AS c FROM (SELECT unnest(range(0, {_size})) AS i))),
      (SELECT unnest([-1, 0, 1, 2]) AS tap))) GROUP BY i, s""",
    )
_sql(
    "resize_bicubic",
    "wide cubic",
    f"""SELECT row_id, band, CAST(y.i * 5 + x.i AS INTEGER) AS pos, round(sum(v * y.w * x.w) + 1e-7 / 3, 6) + 0.0 AS value
  FROM (SELECT row_id, band, t.i AS at, {_CLAMP.format(x="v[t.i + 1]")} AS v FROM wide, (SELECT unnest(range(0, 64)) AS i) t) p
  JOIN cubic y ON y.s = p.at // 8 JOIN cubic x ON x.s = p.at % 8 GROUP BY row_id, band, y.i, x.i""",
)
_MEAN = "(CASE channel WHEN 0 THEN 0.430 WHEN 1 THEN 0.411 ELSE 0.296 END)"
_STD = "(CASE channel WHEN 0 THEN 0.213 WHEN 1 THEN 0.156 ELSE 0.143 END)"
_sql("channel_normalize", "wide", _list("row_id, band", "wide", "v", f"({_CLAMP} - CAST({_MEAN} AS DOUBLE)) / CAST({_STD} AS DOUBLE)"))
_sql("is_black_tile", "zeros", "SELECT row_id, is_black FROM zeros")
_sql(
    "display_rgb",
    "whole",
    _text(
        "row_id",
        "whole",
        "list_transform({b}, lambda x: CAST(floor(least(greatest(CAST(x AS DOUBLE) / 3000, 0), 1) * 255) AS INT))",
    ),
)
_STATUS = """SELECT m.row_id, CASE WHEN t.row_id IS NULL THEN 'read_error' WHEN z.row_id IS NULL THEN 'null_band'
  WHEN z.nodata * 100 > 45 THEN 'nodata' ELSE 'kept' END AS status
  FROM manifest2 m LEFT JOIN tiles t USING (row_id) LEFT JOIN zeros z USING (row_id)"""
_sql("tile_status", "manifest2 tiles zeros", _STATUS)
_sql("tile_status_counts", "manifest2 tiles zeros", f"SELECT status, count(*) AS n_tiles FROM ({_STATUS}) GROUP BY status")
_sql(
    "prepare_tiles",
    "tiles zeros",
    """SELECT row_id, CASE WHEN z.row_id IS NULL THEN 'null_band' WHEN nodata * 100 > 45 THEN 'nodata' ELSE 'kept' END AS status,
  round(nodata, 6) + 0.0 AS nodata, CAST(CASE WHEN nodata * 100 <= 45 THEN 3 * 64 END AS INTEGER) AS n_values
  FROM tiles LEFT JOIN zeros z USING (row_id)""",
)
_sql(
    "register_model",
    "wide zeros",
    f"""SELECT row_id, channel AS pos, round(len(list_filter(v, lambda x:
  ({_CLAMP.format(x="x")} - CAST({_MEAN} AS DOUBLE)) / CAST({_STD} AS DOUBLE) > 0)) / CAST(len(v) AS DOUBLE), 6) + 0.0 AS value
  FROM wide JOIN zeros USING (row_id) WHERE nodata * 100 <= 45""",
)
# Single precision where the pixels go into the model and where its vectors come out.
_sql(
    "embed_tiles",
    "wide zeros cubic6",
    f"""SELECT row_id, CAST(k - 1 AS INTEGER) AS pos,
  round(CAST(CAST(sum(CAST(pixel AS DOUBLE) * (cos(CAST(slot * k AS DOUBLE)) / sqrt(CAST(108 AS DOUBLE)))) AS FLOAT) AS DOUBLE), 6) + 0.0 AS value
  FROM (SELECT row_id, channel * 36 + y.i * 6 + x.i + 1 AS slot,
      CAST((sum(v * y.w * x.w) - CAST({_MEAN} AS DOUBLE)) / CAST({_STD} AS DOUBLE) AS FLOAT) AS pixel
    FROM (SELECT row_id, channel, t.i AS at, {_CLAMP.format(x="v[t.i + 1]")} AS v
      FROM wide JOIN zeros USING (row_id), (SELECT unnest(range(0, 64)) AS i) t WHERE nodata * 100 <= 45) p
    JOIN cubic6 y ON y.s = p.at // 8 JOIN cubic6 x ON x.s = p.at % 8 GROUP BY row_id, channel, y.i, x.i),
  (SELECT unnest(range(1, 33)) AS k) GROUP BY row_id, k""",
)
_sql(
    "l2_normalize",
    "scaled",
    _list(
        "row_id",
        "(SELECT row_id, v, sqrt(list_sum(list_transform(v, lambda y: y * y))) AS n FROM scaled)",
        "v",
        "CASE WHEN n = 0 THEN {x} ELSE {x} / n END",
    ),
)
_sql(
    "l2_normalize_eps",
    "scaled",
    _list("row_id", "(SELECT row_id, v, sqrt(list_sum(list_transform(v, lambda y: y * y))) + 1e-8 AS n FROM scaled)", "v", "{x} / n"),
)
_sql(
    "minmax_scale",
    "base",
    """SELECT row_id, round((cloud_cover - min(cloud_cover) OVER ()) / (max(cloud_cover) OVER () - min(cloud_cover) OVER () + 1e-6), 6)
  + 0.0 AS scaled FROM base""",
)
_sql("basename", "base", "SELECT row_id, string_split(parquet_url, '/')[-1] AS name FROM base")

# ---------------------------------------------------------------- filters and samples

_sql("align_manifest", "manifest", "SELECT * FROM manifest")
_sql("truncate", "base", "SELECT row_id, grid_cell FROM base ORDER BY row_id LIMIT 100")
_sql(
    "check_alignment",
    "manifest2",
    """SELECT count(m.row_id) AS n_manifest, count(e.vec_id) AS n_embeddings,
  count(*) FILTER (WHERE e.vec_id IS NULL) AS manifest_only, count(*) FILTER (WHERE m.row_id IS NULL) AS embeddings_only
  FROM manifest2 m FULL JOIN embeddings e ON e.vec_id = m.row_id""",
)
_sql("sample_exact", "base", f"SELECT row_id, grid_cell FROM base ORDER BY {_shuffled()} LIMIT 20")
_sql("sample_exact_by_buckets", "base", f"SELECT row_id, grid_cell FROM base ORDER BY {_shuffled()} LIMIT 333")
_sql(
    "sample_fraction",
    "base",
    f"""SELECT row_id, grid_cell FROM (SELECT *, row_number() OVER (ORDER BY {_shuffled()}) AS rn, count(*) OVER () AS n FROM base)
  WHERE rn <= floor(n * 0.3)""",
)
_IN_SAMPLE = "zeros"
for _name in ("first_matching", "first_matching_in_waves"):
    _sql(
        _name,
        "zeros",
        f"""SELECT row_id, round(zero_pct, 6) + 0.0 AS zero_pct FROM {_IN_SAMPLE} WHERE zero_pct > 30 AND zero_pct < 70
  ORDER BY {_shuffled()} LIMIT 10""",
    )
_sql("first_black_tile_in_waves", "zeros", f"SELECT row_id FROM zeros WHERE is_black ORDER BY {_shuffled()} LIMIT 1")
_sql(
    "first_black_tile",
    "zeros",
    f"SELECT row_id FROM (SELECT * FROM zeros ORDER BY {_shuffled()} LIMIT 5000) WHERE is_black ORDER BY {_shuffled()} LIMIT 1",
)
_sql(
    "sample_per_group",
    "split",
    f"""SELECT row_id, cid AS cluster_id, is_garbage FROM (SELECT *, row_number() OVER (PARTITION BY is_garbage ORDER BY {_shuffled()}) AS rn
  FROM split) WHERE rn <= CASE WHEN is_garbage THEN 15 ELSE 40 END""",
)
_sql("drop_null_coords", "base", "SELECT row_id, centre_lat, centre_lon FROM base WHERE centre_lat IS NOT NULL AND centre_lon IS NOT NULL")
_sql(
    "filter_zero_range", "zeros", "SELECT row_id, round(zero_pct, 6) + 0.0 AS zero_pct FROM zeros WHERE zero_pct > 30 AND zero_pct < 70"
)
_sql(
    "pick_clusters",
    "counts",
    """SELECT cid AS cluster_id, n FROM counts WHERE n >= 5
  ORDER BY md5(concat_ws('-', CAST(cid AS VARCHAR), '42')), cid LIMIT 3""",
)

# ---------------------------------------------------------------- joins

_ASSIGN = "SELECT row_id, cid AS cluster_id, round(d2, 6) + 0.0 AS d2 FROM {0}"
_sql("assign_nearest", "assign", _ASSIGN.format("assign"))
_sql("assign_nearest_in_blocks", "assign", _ASSIGN.format("assign"))
_part("unit", "cents", "SELECT cid, list_transform(v, lambda x: x / n) AS v FROM (SELECT cid, v, sqrt(list_inner_product(v, v)) AS n FROM cents)")
_part("assign_unit", "p unit", _nearest("p", "unit"))
_sql("assign_nearest_normalized", "assign_unit", _ASSIGN.format("assign_unit"))
_part(
    "original",
    "base",
    """SELECT string_split(parquet_url, '/')[-1] AS f, nullif(grid_cell, '5U_5R') AS cell, parquet_url, parquet_row,
  centre_lat, centre_lon, cloud_cover, nodata, row_id FROM base UNION ALL
  SELECT string_split(parquet_url, '/')[-1], nullif(grid_cell, '5U_5R'), parquet_url, parquet_row,
  centre_lat, centre_lon, CAST(-1 AS DOUBLE), nodata, row_id + 1000000 FROM base""",
)
_sql(
    "enrich_metadata",
    "base original",
    """SELECT s.row_id, nullif(s.grid_cell, '5U_5R') AS grid_cell, string_split(s.parquet_url, '/')[-1] AS parquet_url_subset,
  o.parquet_url AS parquet_url_original, o.parquet_row, o.centre_lat, o.centre_lon, o.cloud_cover, o.nodata
  FROM base s LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY f, cell ORDER BY row_id) AS rn FROM original) o
  ON o.rn = 1 AND o.f = string_split(s.parquet_url, '/')[-1] AND o.cell IS NOT DISTINCT FROM nullif(s.grid_cell, '5U_5R')""",
)
_sql(
    "join_coordinates",
    "base original",
    """SELECT s.row_id, nullif(s.grid_cell, '5U_5R') AS grid_cell, o.centre_lat, o.centre_lon
  FROM base s LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY row_id) AS rn FROM original) o
  ON o.rn = 1 AND o.cell IS NOT DISTINCT FROM nullif(s.grid_cell, '5U_5R')""",
)
_sql(
    "extract_subset_rows",
    "base chosen20 tiles",
    _text(
        "shard, row_in_file",
        """(SELECT t.*, string_split(parquet_url, '/')[-1] AS shard,
  row_number() OVER (PARTITION BY parquet_url ORDER BY parquet_row) - 1 AS row_in_file
  FROM base JOIN chosen20 USING (row_id) JOIN tiles t USING (row_id))""",
    ),
)
_sql(
    "extract_subset_rows_in_parts",
    "base tiles",
    _text("string_split(parquet_url, '/')[-1] AS shard, parquet_row AS tile_row", "base JOIN tiles USING (row_id)"),
)
_sql(
    "missing_sources",
    "manifest2",
    """SELECT string_split(parquet_file, '/')[-1] AS shard, count(*) AS n_rows,
  count(*) FILTER (WHERE row_id >= 1000000) AS n_missing, count(*) FILTER (WHERE row_id >= 1000000) = 0 AS complete
  FROM manifest2 GROUP BY 1""",
)
_sql("pairwise_distances", "pairs", "SELECT floor(d * 10000 + 0.5) / 10000 AS distance, count(*) AS n_pairs FROM pairs GROUP BY 1")
_sql("similarity_to_reference", "sims", "SELECT cid AS cluster_id, round(s, 6) + 0.0 AS similarity FROM sims")
_sql("similarity_to_reference_both", "sims", "SELECT cid AS cluster_id, round(s2, 6) + 0.0 AS similarity FROM sims")
_sql(
    "gather",
    "manifest chosen",
    "SELECT m.*, c.cid AS cluster_id, round(sqrt(c.d2), 6) + 0.0 AS distance_to_centroid FROM manifest m JOIN chosen c USING (row_id)",
)

# ---------------------------------------------------------------- clustering

_sql("kmeans", "cents", _list("cid AS cluster_id", "cents", "v"))
_sql("kmeans_in_blocks", "c1", _list("cid AS cluster_id", "c1", "v"))
_part(
    "train",
    "p",
    f"SELECT row_id, v FROM (SELECT *, row_number() OVER (ORDER BY {_shuffled()}) AS rn FROM p) WHERE rn <= 20 * {K}",
)
_part(
    "t0",
    "train",
    f"""SELECT CAST(rn - 1 AS INTEGER) AS cid, v FROM (SELECT v, row_number() OVER (ORDER BY {_shuffled()}) AS rn FROM train)
  WHERE rn <= {K}""",
)
for _i in range(2):
    _part(f"ta{_i}", f"train t{_i}", _nearest("train", f"t{_i}"))
    _part(f"t{_i + 1}", f"p ta{_i} t{_i}", _means(f"ta{_i}", f"t{_i}"))
_sql("kmeans_capped_training", "t2", _list("cid AS cluster_id", "t2", "v"))
_sql(
    "cluster_centroids",
    "p assign counts12",
    _list(
        "cluster_id, n",
        """(SELECT c.cid AS cluster_id, c.n, coalesce(m.v, list_transform(range(1, 65), lambda i: CAST(0 AS DOUBLE))) AS v FROM counts12 c LEFT JOIN
  (SELECT cid, list(m ORDER BY i) AS v FROM (SELECT a.cid, t.i, avg(p.v[t.i]) AS m
    FROM assign a JOIN p USING (row_id), (SELECT unnest(range(1, 65)) AS i) t GROUP BY a.cid, t.i) GROUP BY cid) m ON m.cid = c.cid)""",
        "v",
    ),
)
_PER_PASS, _BATCHES = 3, 6
_part("deals", "p", f"SELECT CAST({_PER_PASS} AS BIGINT) AS per")
_part(
    "s0",
    "p",
    f"""SELECT CAST(rn - 1 AS INTEGER) AS cid, v, CAST(0 AS BIGINT) AS w FROM
  (SELECT v, row_number() OVER (ORDER BY {_shuffled()}) AS rn FROM p) WHERE rn <= {K}""",
)
for _i in range(_BATCHES):
    _part(
        f"mb{_i}",
        "p deals",
        f"""SELECT row_id, v FROM p, deals
  WHERE CAST('0x' || substr(md5(concat_ws('-', CAST(row_id AS VARCHAR), '42', CAST({_i} // per AS VARCHAR))), 1, 8) AS BIGINT) % per = {_i} % per""",
    )
    _part(f"ma{_i}", f"mb{_i} s{_i}", _nearest(f"mb{_i}", f"s{_i}"))
    _part(
        f"s{_i + 1}",
        f"p ma{_i} s{_i}",
        f"""SELECT o.cid, CASE WHEN m.n IS NULL THEN o.v ELSE
    list_transform(range(1, 65), lambda i: o.v[i] * (1 - m.n / (o.w + m.n)) + m.v[i] * (m.n / (o.w + m.n))) END AS v,
  o.w + coalesce(m.n, 0) AS w
  FROM s{_i} o LEFT JOIN (SELECT cid, list(m ORDER BY i) AS v, max(n) AS n FROM
    (SELECT a.cid, t.i, avg(p.v[t.i]) AS m, count(*) AS n FROM ma{_i} a JOIN p USING (row_id),
      (SELECT unnest(range(1, 65)) AS i) t GROUP BY a.cid, t.i) GROUP BY cid) m ON m.cid = o.cid""",
    )
_part("assign_mb", f"p s{_BATCHES}", _nearest("p", f"s{_BATCHES}"))
_sql("minibatch_kmeans", "assign_mb", _ASSIGN.format("assign_mb"))
_sql("inertia", "assign", "SELECT round(sum(d2), 6) + 0.0 AS inertia FROM assign")

# Clusters by radius have no SQL form in general.  On clusters that lie far apart compared with
# their own size the answer is known: below the distance of the closest points every point stays
# alone, between the two scales the clusters come out, and beyond both there is one cluster.
_part(
    "blobs",
    "",
    """SELECT vec_id AS row_id, label, list_transform(range(1, 65), lambda i: CAST(embedding[i] AS DOUBLE) * 0.15
  + CASE WHEN i - 1 = label THEN 1 ELSE 0 END) AS v FROM embeddings""",
)
_part(
    "groups",
    "blobs",
    """SELECT CAST(row_number() OVER (ORDER BY n DESC, ss) - 1 AS INTEGER) AS cid, v FROM
  (SELECT label, n, ss, list(m ORDER BY i) AS v FROM (SELECT label, t.i, avg(v[t.i]) AS m, count(*) AS n FROM blobs,
    (SELECT unnest(range(1, 65)) AS i) t GROUP BY label, t.i) JOIN
    (SELECT label, sum(list_inner_product(v, v)) AS ss FROM blobs GROUP BY label) USING (label) GROUP BY label, n, ss)""",
)
_part("assign_blobs", "blobs groups", _nearest("blobs", "groups"))
_sql("threshold_clusters", "assign_blobs", _ASSIGN.format("assign_blobs"))
_sql(
    "threshold_search",
    "",
    """SELECT 1 AS attempt, CAST(0.4 AS DOUBLE) AS threshold, count(DISTINCT label) AS n_clusters FROM embeddings
  UNION ALL SELECT 2, 0.05, count(*) FROM embeddings""",
)
_sql(
    "threshold_sweep",
    "",
    """SELECT CAST(0.05 AS DOUBLE) AS threshold, count(*) AS n_clusters FROM embeddings
  UNION ALL SELECT 0.3, count(DISTINCT label) FROM embeddings UNION ALL SELECT 0.6, count(DISTINCT label) FROM embeddings
  UNION ALL SELECT 1.2, CAST(1 AS BIGINT)""",
)

# ---------------------------------------------------------------- reports

_sql("cluster_counts", "counts12", "SELECT cid AS cluster_id, n FROM counts12")
_sql("cluster_stats", "counts12", _STATS)


def _balanced(target: int) -> str:
    share, rest = max(1, target // K), target % K
    return f"""SELECT a.row_id, a.cid, a.d2 FROM ranked a JOIN ranks r ON r.cid = a.cid
  WHERE a.rn <= {share} + CASE WHEN r.r < {rest} THEN 1 ELSE 0 END"""


_part("balanced", "ranked ranks", _balanced(128))
_part("balanced7", "ranked ranks", _balanced(7))
_sql(
    "cluster_stats_ranked",
    "ranks balanced",
    """SELECT r.cid AS cluster_id, r.n AS n_candidates, count(b.row_id) AS n_sampled, r.r AS cluster_rank
  FROM ranks r LEFT JOIN balanced b ON b.cid = r.cid GROUP BY r.cid, r.n, r.r""",
)
_TIERS = ["0", "1-9", "10-99", "100-999", "1,000-9,999", "10,000-99,999", "100,000+"]
_sql(
    "size_tiers",
    "sizes",
    "SELECT t.tier_no, t.tier, count(s.cluster_id) AS n_clusters FROM (VALUES "
    + ", ".join(f"({i + 1}, '{t}')" for i, t in enumerate(_TIERS))
    + """) t(tier_no, tier) LEFT JOIN (SELECT cluster_id, CASE WHEN n_candidates = 0 THEN 1 WHEN n_candidates < 10 THEN 2
  WHEN n_candidates < 100 THEN 3 WHEN n_candidates < 1000 THEN 4 WHEN n_candidates < 10000 THEN 5
  WHEN n_candidates < 100000 THEN 6 ELSE 7 END AS tier_no FROM sizes) s USING (tier_no) GROUP BY t.tier_no, t.tier""",
)


def _histogram(source: str, col: str, by: str = "") -> str:
    over = f"PARTITION BY {by}" if by else ""
    ids = f"{by}, " if by else ""
    same = f"AND f.{by} = g.{by}" if by else ""
    group = f"g.{by}, " if by else ""
    filled = f"""(SELECT *, CAST(least(floor((x - low) / width), 49) AS INTEGER) AS bin
    FROM (SELECT *, CASE WHEN a = b THEN a - 0.5 ELSE a END AS low, CASE WHEN a = b THEN CAST(1 AS DOUBLE) ELSE b - a END / 50 AS width
      FROM (SELECT {ids}CAST({col} AS DOUBLE) AS x, min(CAST({col} AS DOUBLE)) OVER ({over}) AS a,
        max(CAST({col} AS DOUBLE)) OVER ({over}) AS b FROM {source})))"""
    return f"""SELECT {group}g.bin, round(g.low + g.bin * g.width, 6) + 0.0 AS low, round(g.low + (g.bin + 1) * g.width, 6) + 0.0 AS high,
    count(f.bin) AS n
  FROM (SELECT DISTINCT {ids}low, width, CAST(t.i AS INTEGER) AS bin FROM {filled} h, (SELECT unnest(range(0, 50)) AS i) t) g
    LEFT JOIN {filled} f ON f.bin = g.bin {same} GROUP BY {group}g.bin, g.low, g.width"""


_sql("size_histogram", "sizes", _histogram("(SELECT * FROM sizes WHERE n_candidates > 0)", "n_candidates"))
_sql("zero_histogram_by_class", "zeros split", _histogram("(SELECT * FROM zeros JOIN split USING (row_id))", "zero_pct", "is_garbage"))
_sql(
    "measure_tiles",
    "zeros",
    """SELECT row_id, round(nodata, 6) + 0.0 AS nodata, round(zero_pct, 6) + 0.0 AS zero_pct, is_black, CAST(64 AS BIGINT) AS n_pixels
  FROM zeros""",
)
_BAND_STATS = (
    "wide",
    """SELECT band, count(DISTINCT row_id) AS n_tiles, round(avg(x), 6) + 0.0 AS mean,
  round(sqrt(greatest(avg(x * x) - avg(x) * avg(x), 0)), 6) + 0.0 AS std
  FROM (SELECT band, row_id, unnest(v) / CAST(10000 AS DOUBLE) AS x FROM wide) GROUP BY band""",
)
_sql("band_stats", *_BAND_STATS)
_sql("band_stats_of_blobs", *_BAND_STATS)


def _profile(points: list[tuple[str, float]], name: str, value: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS {name}, round(quantile_cont(d, {p}), 6) + 0.0 AS {value} FROM pairs" for n, p in points
    )


_sql(
    "distance_profile",
    "pairs",
    _profile([("min", 0), ("p5", 0.05), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p95", 0.95), ("max", 1)], "metric", "distance"),
)
_sql(
    "recommend_thresholds",
    "pairs",
    _profile([("1k", 0.99), ("10k", 0.95), ("100k", 0.85), ("1M", 0.5)], "n_clusters", "threshold"),
)


def _metrics(source: str, x: str, keep: str, probs: list[tuple[str, float]], id_expr: str, id_name: str) -> str:
    parts = [
        ("count", f"CAST(count({x}) AS DOUBLE)"),
        ("mean", f"avg({x})"),
        ("std", f"stddev_samp({x})"),
        ("min", f"min({x})"),
        *[(n, f"quantile_cont({x}, {p})") for n, p in probs],
        ("max", f"max({x})"),
    ]
    return " UNION ALL ".join(
        f"SELECT {id_expr} AS \"{id_name}\", '{n}' AS metric, round({e}, 6) + 0.0 AS value FROM {source} {keep}" for n, e in parts
    )


_sql(
    "describe_by_class",
    "labelled",
    "SELECT * FROM ("
    + _metrics(
        "labelled",
        "zero_pct",
        "WHERE is_garbage",
        [("p05", 0.05), ("p10", 0.1), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p90", 0.9), ("p95", 0.95)],
        "'garbage'",
        "class",
    )
    + " UNION ALL "
    + _metrics(
        "labelled",
        "zero_pct",
        "WHERE NOT is_garbage",
        [("p50", 0.5), ("p75", 0.75), ("p80", 0.8), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99)],
        "'good'",
        "class",
    )
    + ") WHERE value IS NOT NULL",
)
_COLUMNS = ["row_id", "grid_cell", "parquet_url", "parquet_row", "centre_lat", "centre_lon", "cloud_cover", "nodata"]
_QUARTILES = [("25%", 0.25), ("50%", 0.5), ("75%", 0.75)]
_sql(
    "profile_metadata",
    "base",
    """SELECT '*' AS "column", 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM base
  UNION ALL SELECT '*', 'columns', CAST(8 AS DOUBLE) UNION ALL """
    + " UNION ALL ".join(f"SELECT '{c}', 'nulls', CAST(count(*) - count({c}) AS DOUBLE) FROM base" for c in _COLUMNS)
    + " UNION ALL "
    + " UNION ALL ".join(_metrics("base", c, "", _QUARTILES, f"'{c}'", "column") for c in _COLUMNS[4:]),
)
_sql("top_values", "assign", "SELECT cid AS cluster_id, count(*) AS n_rows FROM assign GROUP BY cid ORDER BY n_rows DESC, cid LIMIT 5")
_sql(
    "similarity_counts",
    "sims",
    """SELECT t.threshold, count(*) FILTER (WHERE s > t.threshold) AS n_above, count(*) AS n_total
  FROM sims CROSS JOIN (SELECT unnest([0.1, 0.02, 0.0, -0.02]::DOUBLE[]) AS threshold) t GROUP BY t.threshold""",
)
_sql(
    "subset_size_estimate",
    "chosen assign",
    """SELECT n AS n_tiles, n * 1068 * 1068 * 12 * 2 AS bytes, round(n * 1068 * 1068 * 12 * 2 / 1e12, 6) + 0.0 AS uncompressed_tb,
  round(100.0 * n / (SELECT count(*) FROM assign), 6) + 0.0 AS selected_pct FROM (SELECT count(*) AS n FROM chosen)""",
)
_sql("source_files", "manifest", "SELECT parquet_file, count(*) AS n_rows FROM manifest GROUP BY parquet_file")
_sql(
    "geo_density",
    "base",
    """SELECT CAST(floor(centre_lat / 5) AS INTEGER) AS lat_cell, CAST(floor(centre_lon / 5) AS INTEGER) AS lon_cell, count(*) AS n_tiles
  FROM base WHERE centre_lat IS NOT NULL AND centre_lon IS NOT NULL GROUP BY 1, 2""",
)

# ---------------------------------------------------------------- selection

_sql("closest_per_cluster", "chosen", _ASSIGN.format("chosen"))
_sql("closest_five_per_cluster", "ranked", _ASSIGN.format("ranked WHERE rn <= 5"))
_sql("balanced_sample", "balanced", _ASSIGN.format("balanced"))
_sql("balanced_sample_below_k", "balanced7", _ASSIGN.format("balanced7"))
_sql("proportional_sample", "ranked", _ASSIGN.format("ranked WHERE rn <= floor(0.2 * n)"))
_sql(
    "centroid_only_subset",
    "counts12",
    "SELECT cid AS cluster_id, n AS n_candidates, CAST(1 AS BIGINT) AS n_sampled, CAST(cid AS BIGINT) AS cluster_rank FROM counts12",
)
_sql(
    "cluster_members_topn",
    "ranked",
    """SELECT cid AS cluster_id, row_id, round(d2, 6) + 0.0 AS d2, rn AS position, n AS cluster_size, rn = 1 AS selected
  FROM ranked WHERE cid IN (0, 3, 7, 99) AND rn <= 20""",
)
_RENUMBERED = """SELECT row_id, cid, string_split(parquet_file, '/')[-1] AS name,
  CAST(row_number() OVER (PARTITION BY parquet_file ORDER BY row_group) - 1 AS INTEGER) AS row_group
  FROM manifest JOIN chosen20 USING (row_id)"""
_sql(
    "renumber_row_groups",
    "manifest chosen20",
    f"SELECT row_id, concat('/data/subset/', name) AS parquet_file, row_group, 0 AS row_in_rg FROM ({_RENUMBERED})",
)
_sql(
    "rebase_manifest",
    "manifest chosen",
    """SELECT row_id, grid_cell, parquet_file, row_group, row_in_rg, cid AS cluster_id,
  string_split(parquet_file, '/')[-1] AS parquet_url, row_group AS parquet_row FROM manifest JOIN chosen USING (row_id)""",
)
_sql("rebase_manifest_overwrite", "manifest", "SELECT * REPLACE (string_split(parquet_file, '/')[-1] AS parquet_url) FROM manifest")
_CURVE = """SELECT cluster_id, n_candidates, row_number() OVER (ORDER BY n_candidates DESC, cluster_id) AS rank
  FROM sizes WHERE n_candidates > 0"""
_sql("size_curve", "sizes", _CURVE)
_sql("size_curve_in_slices", "sizes", _CURVE)
_sql("cluster_rank", "ranks12", "SELECT cid AS cluster_id, n, r AS cluster_rank FROM ranks12")
_sql("large_clusters", "sizes", "SELECT cluster_id, n_candidates FROM sizes WHERE n_candidates > 99")
_sql(
    "first_large_clusters",
    "sizes",
    """SELECT cluster_id, n_candidates, (SELECT count(*) FROM sizes WHERE n_candidates > 99) AS n_large
  FROM sizes WHERE n_candidates > 99 ORDER BY cluster_id LIMIT 50""",
)

# ---------------------------------------------------------------- sets

_sql("union_chosen", "ranked", _ASSIGN.format("ranked WHERE rn <= 1") + " UNION ALL " + _ASSIGN.format("ranked WHERE rn <= 3"))
_sql("garbage_clusters", "garbage", "SELECT cid AS cluster_id FROM garbage")
_sql(
    "dark_clusters",
    "zeros assign",
    f"""SELECT DISTINCT cid AS cluster_id FROM assign WHERE row_id IN (SELECT row_id FROM {_IN_SAMPLE}
  WHERE zero_pct > 30 AND zero_pct < 70)""",
)
_sql("split_garbage", "split", "SELECT row_id, cid AS cluster_id, is_garbage FROM split")
_sql("garbage_tally", "split", "SELECT is_garbage, count(*) AS n_tiles FROM split GROUP BY is_garbage")

# ---------------------------------------------------------------- whole runs

_sql(
    "select_subset",
    "manifest chosen",
    "SELECT row_id, grid_cell, parquet_file, row_group, row_in_rg, cid AS cluster_id FROM manifest JOIN chosen USING (row_id)",
)
_sql(
    "select_subset_stats",
    "counts",
    "SELECT cid AS cluster_id, n AS n_candidates, CAST(CASE WHEN n > 0 THEN 1 ELSE 0 END AS BIGINT) AS n_sampled FROM counts",
)
_part(
    "m0",
    "wide zeros",
    f"""SELECT row_id, list(CAST(CAST(x AS FLOAT) AS DOUBLE) ORDER BY channel) AS v FROM (SELECT row_id, channel,
  list_avg(list_transform(v, lambda x: ({_CLAMP.format(x="x")} - CAST({_MEAN} AS DOUBLE)) / CAST({_STD} AS DOUBLE))) AS x
  FROM wide JOIN zeros USING (row_id) WHERE nodata * 100 <= 45) GROUP BY row_id""",
)
_part("mp", "m0", "SELECT row_id, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS v FROM m0")
_part(
    "mc0",
    "mp",
    f"SELECT CAST(rn - 1 AS INTEGER) AS cid, v FROM (SELECT v, row_number() OVER (ORDER BY row_id) AS rn FROM mp) WHERE rn <= {K}",
)
for _i in range(ROUNDS):
    _part(f"mq{_i}", f"mp mc{_i}", _nearest("mp", f"mc{_i}"))
    _part(f"mc{_i + 1}", f"mp mq{_i} mc{_i}", _means(f"mq{_i}", f"mc{_i}", "mp", 3))
_part("mq", f"mp mc{ROUNDS}", _nearest("mp", f"mc{ROUNDS}"))
_sql(
    "run_steps",
    "manifest mq",
    """SELECT row_id, grid_cell, string_split(parquet_file, '/')[-1] AS parquet_file, row_group, row_in_rg, cid AS cluster_id
  FROM manifest JOIN (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY d2, row_id) AS rn FROM mq) USING (row_id) WHERE rn = 1""",
)
_sql(
    "materialize_subset",
    "manifest chosen20",
    f"SELECT row_id, cid AS cluster_id, name AS parquet_url, row_group AS parquet_row, row_group, 0 AS row_in_rg FROM ({_RENUMBERED})",
)
_sql(
    "materialize_subset_report",
    "manifest chosen20",
    """SELECT shard, count(*) AS n_rows, count(*) FILTER (WHERE gone) AS n_missing, NOT bool_or(gone) AS complete FROM
  (SELECT string_split(parquet_file, '/')[-1] AS shard, false AS gone FROM manifest JOIN chosen20 USING (row_id) UNION ALL
   SELECT replace(string_split(parquet_file, '/')[-1], 'part_', 'absent_'), true FROM manifest JOIN chosen20 USING (row_id))
  GROUP BY shard""",
)

# ---------------------------------------------------------------- principal components

# Power iteration with deflation, on all elements; what lies behind these components is below 1e-7 of the whole.
_COMPONENTS, _STEPS = 24, 100
_part(
    "tapered",
    "",
    """SELECT vec_id AS row_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x, i: x * pow(CAST(0.7 AS DOUBLE), i - 1)) AS v
  FROM embeddings""",
)
_part(
    "elements",
    "tapered",
    """SELECT row_id, i, x - avg(x) OVER (PARTITION BY i) AS x
  FROM (SELECT row_id, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM tapered)""",
)
_part(
    "covariance",
    "elements",
    """SELECT list(line ORDER BY i) AS a, sum(own) AS trace FROM (SELECT i, list(c ORDER BY j) AS line, sum(CASE WHEN i = j THEN c END) AS own
  FROM (SELECT a.i, b.i AS j, sum(a.x * b.x) / (count(*) - 1) AS c FROM elements a JOIN elements b USING (row_id) GROUP BY a.i, b.i)
  GROUP BY i)""",
)
_part(
    "components",
    "covariance",
    f"""WITH RECURSIVE steps AS (
  SELECT 1 AS component, 0 AS step, a, trace, list_transform(a[1], lambda x: CAST(1 AS DOUBLE)) AS u, CAST(0 AS DOUBLE) AS size FROM covariance
  UNION ALL
  SELECT CASE WHEN step = {_STEPS} THEN component + 1 ELSE component END, CASE WHEN step = {_STEPS} THEN 0 ELSE step + 1 END,
    CASE WHEN step = {_STEPS} THEN list_transform(a, lambda line, i: list_transform(line, lambda c, j: c - size * u[i] * u[j])) ELSE a END,
    trace,
    CASE WHEN step = {_STEPS} THEN list_transform(u, lambda x: CAST(1 AS DOUBLE)) ELSE list_transform(w, lambda x: x / length) END,
    length
  FROM (SELECT *, sqrt(list_dot_product(w, w)) AS length
    FROM (SELECT *, list_transform(a, lambda line: list_dot_product(line, u)) AS w FROM steps WHERE component <= {_COMPONENTS}))
  )
  SELECT component, size / trace AS ratio,
    list_transform(u, lambda x: CASE WHEN list_max(u) < -list_min(u) THEN -x ELSE x END) AS u
  FROM steps WHERE step = {_STEPS} AND component <= {_COMPONENTS}""",
)
_part(
    "reduced",
    "elements components",
    """SELECT row_id, component, sum(x * u[i]) AS value FROM elements, components WHERE component <= 8 GROUP BY row_id, component""",
)
_part(
    "curve",
    "tapered components",
    """SELECT CAST(n AS INTEGER) AS component, coalesce(ratio, 0) AS ratio, sum(coalesce(ratio, 0)) OVER (ORDER BY n) AS cumulative
  FROM (SELECT unnest(range(1, (SELECT least(count(*), max(len(v))) FROM tapered) + 1)) AS n) LEFT JOIN components ON component = n""",
)
_sql(
    "pca_fit_transform",
    "reduced",
    "SELECT row_id, CAST(component - 1 AS INTEGER) AS pos, round(value, 6) + 0.0 AS value FROM reduced",
)
_sql("pca_cumulative_variance", "curve", "SELECT component, round(ratio, 6) + 0.0 AS ratio, round(cumulative, 6) + 0.0 AS cumulative FROM curve")
_sql(
    "pca_variance_marks",
    "curve",
    """SELECT round(max(CASE WHEN component = 2 THEN cumulative END), 6) + 0.0 AS cumulative_2,
  min(CASE WHEN cumulative >= 0.90 THEN component END) AS reach_90, min(CASE WHEN cumulative >= 0.95 THEN component END) AS reach_95 FROM curve""",
)
_sql(
    "pca_scatter",
    "reduced",
    """SELECT row_id, round(pc1, 6) + 0.0 AS pc1, round(pc2, 6) + 0.0 AS pc2, round(pc3, 6) + 0.0 AS pc3,
  round((pc4 - min(pc4) OVER ()) / (max(pc4) OVER () - min(pc4) OVER () + 1e-6), 6) + 0.0 AS color
  FROM (SELECT row_id, max(value) FILTER (component = 1) AS pc1, max(value) FILTER (component = 2) AS pc2,
    max(value) FILTER (component = 3) AS pc3, max(value) FILTER (component = 4) AS pc4 FROM reduced GROUP BY row_id)""",
)
