"""DuckDB SQL for each registered query (the correctness oracle).

The fixtures (paths ``P``, labelled paths ``L``, long tile ``TL``, u8 tile
``T8``) are written once as CTEs and shared.  Tensor operators are written
relationally: a pixel table joined to tap offsets (stencils, resize) or to
four bilinear taps (rotation) and grouped.  Numeric literals that must equal
the Spark plan's bit for bit are rendered from the same Python values.
"""

from __future__ import annotations

from .catalog import ALL_AUG_CFG, TILE_CFG
from .derived import FILE_CFG, V2_CFG


def _d(x: float) -> str:
    """A double literal DuckDB reads to the same IEEE value as Python."""
    return f"{float(x)!r}::double"


P = """P AS (
  select vec_id, embedding, concat('raw/v1.0/',
    case when vec_id % 10 < 6 then 'train' when vec_id % 10 = 6 then 'val'
         when vec_id % 10 = 7 then 'validation' when vec_id % 10 = 8 then 'test' else 'holdout' end, '/',
    case when label < 5 then 'NORMAL' when label < 8 then 'PNEUMONIA' when label = 8 then 'other' else 'Pneumonia' end,
    '/img', cast(vec_id as varchar), '.',
    case when vec_id % 3 = 0 then 'jpeg' when vec_id % 3 = 1 then 'jpg' else 'png' end) as path
  from embeddings)"""

LABEL_SQL = "case when contains(upper({p}), 'NORMAL') then 0 when contains(upper({p}), 'PNEUMONIA') then 1 else -1 end"

L = r"""L AS (
  select vec_id, path,
    case when contains(upper(path), 'NORMAL') then 0 when contains(upper(path), 'PNEUMONIA') then 1 else -1 end as label,
    case when contains(replace(path, '\', '/'), '/train/') then 'train'
         when contains(replace(path, '\', '/'), '/val/') then 'validation'
         when contains(replace(path, '\', '/'), '/validation/') then 'validation'
         when contains(replace(path, '\', '/'), '/test/') then 'test' else 'unknown' end as split
  from P)"""

KL = "KL AS (select * from L where label >= 0)"

TL = """TL AS (select vec_id, unnest(range(0, len(embedding))) as pos, unnest(embedding)::double as v from embeddings)"""

T8 = "T8 AS (select vec_id, pos, floor((v + 1.0) * 127.5) as v from TL)"

T3 = """T3 AS (select vec_id, pos * 3 as pos, v from T8
  union all select vec_id, (63 - pos) * 3 + 1, v from T8
  union all select vec_id, ((pos + 63) % 64) * 3 + 2, v from T8)"""

# labelled tiles, keyed by image path
SRC = "SRC AS (select KL.path as image_path, KL.split, KL.label, TL.pos, TL.v from KL join TL using (vec_id))"

MM = """MM AS (select S.image_path, S.pos, (S.v - m.mn) / (m.mx - m.mn + 1e-8) * 1.0 + 0.0 as v
  from SRC S join (select image_path, min(v) as mn, max(v) as mx from SRC group by image_path) m using (image_path))"""


def U(name: str, path: str = "image_path", index: str | None = "aug", seed: int = 42) -> str:
    parts = [f"'{seed}'", path]
    if index is not None:
        parts.append(f"cast({index} as varchar)")
    if name:
        parts.append(f"'{name}'")
    return (
        f"((('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::BIGINT) / 4294967296.0::double)"
    )


def R6(x: str) -> str:
    return f"(round(({x})::double, 6) + 0.0)"


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def _label_sql(cfg, p: str = "path") -> str:
    whens = " ".join(f"when contains(upper({p}), '{name.upper()}') then {int(code)}" for name, code in cfg.label_encoding)
    return f"case {whens} else -1 end"


def _kl_ctes(cfg, sfx: str) -> list[str]:
    """L{sfx}/KL{sfx}: labelled paths under ``cfg`` (label set, extensions)."""
    exts = ", ".join(f"'{e.lower()}'" for e in cfg.extensions)
    return [
        f"""L{sfx} AS (select vec_id, path, {_label_sql(cfg)} as label, split from L)""",
        f"""KL{sfx} AS (select * from L{sfx} where label >= 0
  and lower(regexp_extract(path, '\\.([^./\\\\]+)$', 1)) in ({exts}))""",
    ]


def _variants_cte(cfg, sfx: str = "", kl: str = "KL") -> str:
    """A{sfx}: one row per (image, variant) with the seeded parameters."""
    r = float(cfg.rotation_range)
    ang = f"case when aug > 0 then {_d(-r)} + {U('rotate')} * {_d(r - (-r))} end" if r > 0 else "null::double"
    hf = f"case when aug > 0 then {U('hflip')} > 0.5 end" if cfg.horizontal_flip else "null::boolean"
    vf = f"case when aug > 0 then {U('vflip')} > 0.5 end" if cfg.vertical_flip else "null::boolean"
    if cfg.brightness_range is not None:
        lo, hi = cfg.brightness_range
        br = f"case when aug > 0 then {_d(lo)} + {U('brightness')} * {_d(hi - lo)} end"
    else:
        br = "null::double"
    return f"""A{sfx} AS (select image_path, split, label, aug, {ang} as angle, {hf} as hf, {vf} as vf, {br} as br
  from (select path as image_path, split, label, unnest(range(0, {cfg.augmentation_factor + 1})) as aug from {kl}))"""


def _rotate_ctes(src: str, out: str, w: int = 8, h: int = 8, sfx: str = "", c: int = 1) -> list[str]:
    """Rotate ``src`` (image_path, pos, v) per variant of A (aug > 0) into
    ``out`` (image_path, aug, pos, v); variant 0 and rows with no angle copy
    the source.  ``pos = (y * w + x) * c + channel``."""
    cx, cy = w / 2.0, h / 2.0
    a = f"A{sfx}"
    px = f"(S.pos // {c})" if c > 1 else "S.pos"
    ch = f"(S.pos % {c})" if c > 1 else "0"
    return [
        f"""RC{sfx} AS (select A.image_path, A.aug, S.pos, {ch} as ch,
    cos(A.angle * (pi() / 180.0)) * (({px} % {w}) - {_d(cx)}) - sin(A.angle * (pi() / 180.0)) * (({px} // {w}) - {_d(cy)}) + {_d(cx)} as sx,
    sin(A.angle * (pi() / 180.0)) * (({px} % {w}) - {_d(cx)}) + cos(A.angle * (pi() / 180.0)) * (({px} // {w}) - {_d(cy)}) + {_d(cy)} as sy
  from {a} A join {src} S using (image_path) where A.angle is not null)""",
        f"""RT{sfx} AS (select image_path, aug, pos, ch, floor(sy) + t.oy as ty, floor(sx) + t.ox as tx,
    (case when t.ox = 1 then sx - floor(sx) else 1.0 - (sx - floor(sx)) end)
    * (case when t.oy = 1 then sy - floor(sy) else 1.0 - (sy - floor(sy)) end) as w
  from RC{sfx} join (values (0, 0), (0, 1), (1, 0), (1, 1)) t(oy, ox) on true)""",
        f"""ROT{sfx} AS (select RT.image_path, RT.aug, RT.pos,
    sum(case when RT.tx >= 0 and RT.tx < {w} and RT.ty >= 0 and RT.ty < {h} then RT.w * S.v else 0.0 end) as v
  from RT{sfx} RT left join {src} S on S.image_path = RT.image_path and S.pos = (RT.ty * {w} + RT.tx) * {c} + RT.ch
    and RT.tx >= 0 and RT.tx < {w} and RT.ty >= 0 and RT.ty < {h}
  group by RT.image_path, RT.aug, RT.pos)""",
        f"""{out} AS (select image_path, aug, pos, v from ROT{sfx}
  union all select A.image_path, A.aug, S.pos, S.v from {a} A join {src} S using (image_path) where A.angle is null)""",
    ]


def _flip_cte(src: str, out: str, flag: str, axis: str, w: int = 8, h: int = 8, sfx: str = "", c: int = 1) -> str:
    """Each image's pixels as one list, read back at mirrored places: no
    self-join, so the cost stays linear whatever join order is chosen."""
    px, ch = (f"(pos // {c})", f"(pos % {c})") if c > 1 else ("pos", "0")
    if axis == "h":
        mirror = f"(({px} // {w}) * {w} + {w - 1} - {px} % {w}) * {c} + {ch}"
    else:
        mirror = f"(({h - 1} - {px} // {w}) * {w} + {px} % {w}) * {c} + {ch}"
    return f"""{out} AS (select image_path, aug, pos, case when flip then vs[{mirror} + 1] else vs[pos + 1] end as v
  from (select R.image_path, R.aug, A.{flag} as flip, R.vs, unnest(range(0, {w * h * c})) as pos
        from (select image_path, aug, list(v order by pos) as vs from {src} group by image_path, aug) R
        join A{sfx} A on A.image_path = R.image_path and A.aug = R.aug))"""


def _brightness_cte(src: str, out: str, lo: float, hi: float, sfx: str = "") -> str:
    return f"""{out} AS (select R.image_path, R.aug, R.pos,
    case when A.br is not null then least(greatest(R.v * A.br, {_d(lo)}), {_d(hi)}) else R.v end as v
  from {src} R join A{sfx} A on A.image_path = R.image_path and A.aug = R.aug)"""


def _chain_ctes(cfg, src: str, kl: str, sfx: str = "", w: int = 8, h: int = 8, c: int = 1) -> list[str]:
    """min-max -> rotate -> hflip -> vflip -> brightness over the pixel table
    ``src`` (image_path, split, label, pos, v), as REC{sfx}."""
    ctes = [f"""MM{sfx} AS (select S.image_path, S.pos, (S.v - m.mn) / (m.mx - m.mn + 1e-8) * 1.0 + 0.0 as v
  from {src} S join (select image_path, min(v) as mn, max(v) as mx from {src} group by image_path) m using (image_path))"""]
    ctes.append(_variants_cte(cfg, sfx, kl))
    ctes += _rotate_ctes(f"MM{sfx}", f"R1{sfx}", w, h, sfx=sfx, c=c)
    last = f"R1{sfx}"
    if cfg.horizontal_flip:
        ctes.append(_flip_cte(last, f"R2{sfx}", "hf", "h", w, h, sfx=sfx, c=c))
        last = f"R2{sfx}"
    if cfg.vertical_flip:
        ctes.append(_flip_cte(last, f"R3{sfx}", "vf", "v", w, h, sfx=sfx, c=c))
        last = f"R3{sfx}"
    if cfg.brightness_range is not None:
        ctes.append(_brightness_cte(last, f"R4{sfx}", cfg.norm_min, cfg.norm_max, sfx=sfx))
        last = f"R4{sfx}"
    ctes.append(
        f"REC{sfx} AS (select R.image_path, R.aug, A.split, A.label, R.pos, R.v from {last} R join A{sfx} A using (image_path, aug))"
    )
    return ctes


def _records_long_ctes(cfg, sfx: str = "", base: bool = True) -> list[str]:
    """The whole tile chain under ``cfg`` as REC{sfx}(image_path, aug,
    split, label, pos, v)."""
    ctes = [P, L, TL] if base else []
    if sfx:
        ctes += _kl_ctes(cfg, sfx)
        kl = f"KL{sfx}"
    else:
        ctes.append(KL)
        kl = "KL"
    ctes.append(f"SRC{sfx} AS (select K.path as image_path, K.split, K.label, TL.pos, TL.v from {kl} K join TL using (vec_id))")
    return ctes + _chain_ctes(cfg, f"SRC{sfx}", kl, sfx)


def _resize_sql(m: int, n: int = 8) -> str:
    s = n / m
    wt = f"""W AS (select o, i, greatest(0.0, least((o + 1) * {_d(s)}, i + 1) - greatest(o * {_d(s)}, i)) / {_d(s)} as w
  from range(0, {m}) a(o) join range(0, {n}) b(i) on true)"""
    return with_(TL, wt) + f"""select TL.vec_id, wy.o * {m} + wx.o as pos, {R6('sum(wy.w * wx.w * TL.v)')} as value
from TL join W wy on wy.i = TL.pos // {n} join W wx on wx.i = TL.pos % {n}
group by TL.vec_id, wy.o, wx.o"""


def _resize_linear_sql(mh: int, mw: int, n: int = 8) -> str:
    """Two taps for each output sample, used when not both axes shrink."""

    def taps(name: str, m: int) -> str:
        s = f"({_d(n)} / {_d(m)})"
        first, f = f"floor(o * {s})::BIGINT", f"((o + 1) - (floor(o * {s}) + 1) / {s})"
        return f"""{name} AS (select o, least(i0 + k, {n - 1}) as i, case when k = 0 then 1.0::double - f else f end as w
  from (select o, {first} as i0, case when {f} <= 0 then 0.0::double else {f} - floor({f}) end as f, unnest(range(0, 2)) as k
        from range(0, {m}) a(o)))"""

    return with_(TL, taps("WY", mh), taps("WX", mw)) + f"""select TL.vec_id, wy.o * {mw} + wx.o as pos, {R6('sum(wy.w * wx.w * TL.v)')} as value
from TL join WY wy on wy.i = TL.pos // {n} join WX wx on wx.i = TL.pos % {n}
group by TL.vec_id, wy.o, wx.o"""


def _mirror(x: str, n: int = 8) -> str:
    return f"(case when {x} < 0 then -({x}) when {x} > {n - 1} then {2 * (n - 1)} - ({x}) else {x} end)"


def _clamp(x: str, n: int = 8) -> str:
    return f"least(greatest({x}, 0), {n - 1})"


SQL: dict[str, str] = {}

SQL["label_encode"] = with_(P, L) + "select vec_id, path, label from L"
SQL["label_filter"] = with_(P, L) + "select vec_id, path, label from L where label >= 0"
SQL["split_extract"] = with_(P, L) + "select vec_id, path, split from L"
SQL["split_select"] = with_(P, L) + "select vec_id, path, label, split from L where label >= 0 and split = 'train'"

_t1 = TILE_CFG.split_train
_t2 = TILE_CFG.split_train + TILE_CFG.split_validation
_cut = lambda x: f"case when {x} < {_d(_t1)} then 'train' when {x} < {_d(_t2)} then 'validation' else 'test' end"

SQL["ratio_split"] = with_(P, L) + f"""select vec_id, path, u, {_cut('u')} as ratio_split,
  case when split <> 'unknown' then split else {_cut('u')} end as split
from (select *, {U('', path='path', index=None)} as u from L)"""

SQL["ratio_split_stratified"] = with_(P, L) + f"""select vec_id, path, label::BIGINT as label, {_cut('pr')} as split_strat
from (select *, percent_rank() over (partition by label order by u) as pr
      from (select *, {U('', path='path', index=None)} as u from L where label >= 0))"""

SQL["scan_counts"] = with_(P, L) + r"""select split, lower(regexp_extract(path, '\.([^./\\]+)$', 1)) as extension, count(*) as n
from L group by all"""

SQL["split_union"] = with_(P) + r"""select 'v1.0' as root, vec_id, path from P
union all select 'v1.1' as root, vec_id, regexp_replace(path, '^raw/v1\.0/', 'raw/v1.1/') as path from P"""

SQL["limit_images"] = with_(P) + "select vec_id, path from P order by path limit 10"

SQL["distinct_splits"] = with_(P, L) + "select distinct split from L where label >= 0"

SQL["reject_rows"] = with_(P) + f"""select vec_id, path, case when reason = 'unknown_class' then 'label' else 'decode' end as stage, reason
from (select vec_id, path,
  case when embedding is null or len(embedding) <> 64 then 'shape'
       when len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) > 0 then 'non_finite'
       when ({LABEL_SQL.format(p='path')}) < 0 then 'unknown_class' end as reason
  from P) where reason is not null"""

SQL["tensor_stats"] = with_(TL) + f"""select vec_id, {R6('min(v)')} as t_min, {R6('max(v)')} as t_max,
  {R6('avg(v)')} as t_mean, {R6('stddev_pop(v)')} as t_std from TL group by vec_id"""

SQL["norm_min_max"] = with_(TL) + f"""select vec_id, pos, {R6('(v - mn) / (mx - mn + 1e-8) * 1.0 + 0.0')} as value
from TL join (select vec_id, min(v) as mn, max(v) as mx from TL group by vec_id) s using (vec_id)"""

SQL["norm_z_score"] = with_(TL) + f"""select vec_id, pos, {R6('(v - m) / (sd + 1e-8)')} as value
from TL join (select vec_id, avg(v) as m, stddev_pop(v) as sd from TL group by vec_id) s using (vec_id)"""

SQL["norm_none"] = with_(TL) + f"select vec_id, pos, {R6('v')} as value from TL"
SQL["flatten_tensor"] = SQL["norm_none"]
SQL["nest_tensor"] = with_(TL) + f"select vec_id, pos // 8 as y, pos % 8 as x, 0::BIGINT as c, {R6('v')} as value from TL"
SQL["tensor_shape"] = "select vec_id, '8,8,1' as image_shape, len(embedding)::BIGINT as n_values from embeddings"

SQL["to_rgb"] = with_(TL, T8, T3) + f"""select vec_id, 'gray' as src, pos * 3 + k as pos, {R6('v')} as value
from (select vec_id, pos, v, unnest(range(0, 3)) as k from T8)
union all
select vec_id, 'bgr' as src, (pos // 3) * 3 + (2 - pos % 3) as pos, {R6('v')} as value from T3"""

SQL["grayscale"] = with_(TL, T8, T3) + f"""select vec_id, pix as pos, {R6('floor(0.299 * r + 0.587 * g + 0.114 * b + 0.5)')} as value
from (select vec_id, pos // 3 as pix,
        max(case when pos % 3 = 0 then v end) as r, max(case when pos % 3 = 1 then v end) as g,
        max(case when pos % 3 = 2 then v end) as b
      from T3 group by vec_id, pos // 3)"""

SQL["resize_area"] = _resize_sql(4)
SQL["resize_area_frac"] = _resize_sql(5)

SQL["resize_up"] = _resize_linear_sql(13, 12)
SQL["resize_mixed"] = _resize_linear_sql(5, 12)


def _gaussian_sql(taps: list[float]) -> str:
    r = len(taps) // 2
    values = ", ".join(f"({i - r}, {_d(t)})" for i, t in enumerate(taps))
    return with_(TL, f"G AS (select * from (values {values}) t(d, w))") + f"""
select TL.vec_id, TL.pos, {R6('sum(gy.w * gx.w * S.v)')} as value
from TL join G gy on true join G gx on true
join TL S on S.vec_id = TL.vec_id and S.pos = {_mirror('TL.pos // 8 + gy.d')} * 8 + {_mirror('TL.pos % 8 + gx.d')}
group by TL.vec_id, TL.pos"""


def _median_sql(k: int) -> str:
    return with_(TL, f"D AS (select unnest(range({-(k // 2)}, {k // 2 + 1})) as d)") + f"""
select TL.vec_id, TL.pos, {R6('median(S.v)')} as value
from TL join D dy on true join D dx on true
join TL S on S.vec_id = TL.vec_id and S.pos = {_clamp('TL.pos // 8 + dy.d')} * 8 + {_clamp('TL.pos % 8 + dx.d')}
group by TL.vec_id, TL.pos"""


SQL["gaussian_blur"] = _gaussian_sql([0.25, 0.5, 0.25])
SQL["gaussian_blur_7"] = _gaussian_sql([0.03125, 0.109375, 0.21875, 0.28125, 0.21875, 0.109375, 0.03125])
SQL["median_blur"] = _median_sql(3)
SQL["median_blur_5"] = _median_sql(5)

SQL["kernel_rejects"] = """select vec_id,
  case when vec_id % 7 = 0 then 'shape' when vec_id % 11 = 0 then 'no_pixels' else 'processed' end as outcome,
  case when vec_id % 7 = 0 or vec_id % 11 = 0 then 8 else 4 end::BIGINT as height
from embeddings"""

SQL["histogram"] = with_(TL, T8) + """select vec_id, 0::BIGINT as channel, floor(v)::BIGINT as bin, count(*) as cnt
from T8 where v >= 0 and v < 256 group by all"""

SQL["histogram_dataset"] = with_(TL, T8) + """select 0::BIGINT as channel, floor(v)::BIGINT as bin, count(*) as cnt
from T8 where v >= 0 and v < 256 group by all"""

SQL["histogram_dataset_kernel"] = SQL["histogram_dataset"]

SQL["features_json"] = with_(TL, T8) + """select vec_id,
  '{"histogram_channel_0":[' || array_to_string(list_transform(range(0, 256),
      lambda b: cast(len(list_filter(lv, lambda x: x >= 0 and x < 256 and floor(x) = b)) as varchar) || '.0'), ',')
  || ']}' as features
from (select vec_id, list(v) as lv from T8 group by vec_id)"""

SQL["augment_fanout"] = with_(P, L, KL) + """select vec_id, path as image_path, unnest(range(0, 3)) as augmentation_index from KL"""

SQL["aug_params"] = with_(P, L, KL, _variants_cte(ALL_AUG_CFG)) + f"""select image_path, aug as augmentation_index,
  {R6('angle')} as angle, coalesce(hf, false) as hflip, coalesce(vf, false) as vflip, {R6('br')} as brightness from A"""

SQL["aug_rotate"] = with_(P, L, KL, TL, SRC, _variants_cte(ALL_AUG_CFG), *_rotate_ctes("SRC", "R1")) + f"""
select image_path, aug as augmentation_index, pos, {R6('v')} as value from R1"""

SQL["aug_hflip"] = with_(P, L, KL, TL, SRC, _variants_cte(ALL_AUG_CFG),
                         "R0 AS (select A.image_path, A.aug, S.pos, S.v from A join SRC S using (image_path))",
                         _flip_cte("R0", "R1", "hf", "h")) + f"""
select image_path, aug as augmentation_index, pos, {R6('v')} as value from R1"""

SQL["aug_vflip"] = with_(P, L, KL, TL, SRC, _variants_cte(ALL_AUG_CFG),
                         "R0 AS (select A.image_path, A.aug, S.pos, S.v from A join SRC S using (image_path))",
                         _flip_cte("R0", "R1", "vf", "v")) + f"""
select image_path, aug as augmentation_index, pos, {R6('v')} as value from R1"""

SQL["aug_brightness"] = with_(P, L, KL, TL, SRC, MM, _variants_cte(ALL_AUG_CFG),
                              "R0 AS (select A.image_path, A.aug, S.pos, S.v from A join MM S using (image_path))",
                              _brightness_cte("R0", "R1", 0.0, 1.0)) + f"""
select image_path, aug as augmentation_index, pos, {R6('v')} as value from R1"""

RK = "RK AS (select path as image_path, split, label, unnest(range(0, 3)) as aug from KL)"

SQL["split_counts"] = with_(P, L, KL, RK) + "select split, count(*) as n from RK group by split"
SQL["label_counts"] = with_(P, L, KL, RK) + "select label::BIGINT as label, count(*) as n from RK group by label"
SQL["metadata_counts"] = with_(P, L, KL, RK) + """select
  case when grouping(split) = 0 then 'split' when grouping(label) = 0 then 'label' else 'total' end as grouping_set,
  split, cast(label as varchar) as label, count(*) as n
from RK group by grouping sets ((split), (label), ())"""

SQL["metadata_summary"] = with_(P, L, KL, RK) + """select 'v1.0' as version,
  (select count(*) from L) as total_files,
  (select count(*) from L where label >= 0) as total_images,
  (select count(*) from RK) as processed_images,
  (select count(*) from L where label < 0) as unknown_label_files,
  (select '{' || string_agg('"' || split || '":' || n, ',' order by split) || '}'
     from (select split, count(*) as n from RK group by split)) as splits,
  (select '{' || string_agg('"' || cast(label as varchar) || '":' || n, ',' order by cast(label as varchar)) || '}'
     from (select label, count(*) as n from RK group by label)) as labels,
  '[8,8]' as image_shape, 'min_max' as normalization"""

SQL["dataset_statistics"] = with_(P, L, KL, TL, SRC) + f"""select split, label::BIGINT as label, 0::BIGINT as channel,
  count(distinct image_path) as n_images, count(*) as n_values,
  {R6('avg(v)')} as v_mean, {R6('stddev_pop(v)')} as v_std, {R6('min(v)')} as v_min, {R6('max(v)')} as v_max,
  count(distinct '8,8,1') as n_shapes
from SRC group by split, label"""

SQL["dataset_statistics_kernel"] = SQL["dataset_statistics"]

BA = """BA AS (select image_path, aug, split, (rn - 1) // 32 as batch_id, (rn - 1) % 32 as batch_pos
  from (select *, row_number() over (partition by split
          order by md5(concat_ws('|', '42', image_path, cast(aug as varchar))), image_path, aug) as rn from RK))"""

SQL["batch_assign"] = with_(P, L, KL, RK, BA) + """select image_path, aug as augmentation_index, split, batch_id, batch_pos from BA"""
SQL["batch_assign_scaled"] = SQL["batch_assign"]
SQL["batch_assign_ordered"] = with_(P, L, KL, RK) + """select image_path, aug as augmentation_index, label::BIGINT as label, split,
  (rn - 1) // 32 as batch_id, (rn - 1) % 32 as batch_pos
from (select *, row_number() over (partition by split order by image_path, aug) as rn from RK)"""
SQL["batch_collect"] = with_(P, L, KL, RK, BA) + """select split, batch_id, count(*) as batch_size,
  string_agg(image_path || '#' || cast(aug as varchar), ',' order by batch_pos) as members
from BA group by split, batch_id"""

SQL["pipeline_records"] = with_(*_records_long_ctes(TILE_CFG)) + f"""select image_path, aug as augmentation_index, split,
  label::BIGINT as label, pos, {R6('v')} as value from REC"""

SQL["pipeline_records_kernel"] = with_(*_records_long_ctes(TILE_CFG)) + f"""select image_path, aug as augmentation_index,
  split, label::BIGINT as label, pos, {R6('v::float')} as value from REC"""

SCANNED = "split_part(path, '/', 3) in ('train', 'val', 'validation', 'test')"
REL = r"regexp_replace(regexp_replace(path, '^raw/v1\.0/', ''), '\.(jpeg|jpg|png)$', '.png')"

SQL["image_scan"] = with_(P, TL, T8) + f"""select {REL} as rel_path, 8::BIGINT as height, 8::BIGINT as width,
  3::BIGINT as channels, T.pos * 3 + T.k as pos, {R6('T.v')} as value
from P join (select vec_id, pos, v, unnest(range(0, 3)) as k from T8) T using (vec_id)
where {SCANNED}"""

SQL["stream_ingest"] = with_(P, L, KL) + f"""select {REL} as rel_path, unnest(range(0, 3)) as augmentation_index, split,
  label::BIGINT as label, (8 * 8 * 3)::BIGINT as n_values
from KL where {SCANNED}"""

SQL["batch_then_ingest"] = SQL["stream_ingest"]

SQL["ingest_after_failure"] = with_(P, L, KL, f"""RF AS (select {REL} as rel_path, split, unnest(range(0, 3)) as aug from KL where {SCANNED})""") + f"""
select 'record' as kind, rel_path, split, aug as n from RF
union all select 'example', rel_path, split, 192 from RF
union all select 'batch', '', split, least(32, total - 32 * i)
  from (select split, total, unnest(range(0, (total + 31) // 32)) as i from (select split, count(*) as total from RF group by split))
union all select 'reject', {REL}, split, -1 from L where label < 0 and {SCANNED}"""

SQL["reject_files"] = with_(P, L) + f"""select {REL} as rel_path,
  case when label < 0 then 'label' else 'decode' end as stage, case when label < 0 then 'unknown_class' else 'decode_error' end as reason
from L where {SCANNED} and (label < 0 or vec_id % 7 = 3)"""

SQL["limited_run"] = with_(P, L, f"""FF AS (select {REL} as rel_path, split, label from L where {SCANNED} order by rel_path limit 10)""") + """
select rel_path, split, label::BIGINT as label, unnest(range(0, 3)) as augmentation_index from FF where label >= 0"""

SQL["multi_root_run"] = with_(P, L, KL, f"""MR AS (select 'v1.0' as root, * from KL where {SCANNED}
  union all select 'v1.1' as root, * from KL where {SCANNED} and vec_id % 3 = 0)""") + f"""
select root, {REL} as rel_path, split, label::BIGINT as label, unnest(range(0, 3)) as augmentation_index from MR"""

SQL["parquet_roundtrip"] = with_(*_records_long_ctes(TILE_CFG)) + f"""select image_path, aug as augmentation_index, split,
  label::BIGINT as label, pos, {R6('v::float')} as value from REC"""

SQL["tfrecord_encode"] = with_(*_records_long_ctes(TILE_CFG)) + f"""select image_path, aug as augmentation_index, split,
  label::BIGINT as label, '8,8,1' as image_shape, pos, {R6('v::float')} as value from REC"""

SQL["tfrecord_roundtrip"] = with_(*_records_long_ctes(TILE_CFG)) + f"""select image_path, split,
  label::BIGINT as label, '8,8,1' as image_shape, pos, {R6('v::float')} as value from REC"""

_EXT = r"lower(regexp_extract(path, '\.([^./\\]+)$', 1))"

SQL["validate_input"] = with_(P, L, f"""S AS (select count(*) as files, count(*) filter (where label >= 0) as known_labels,
  count(*) filter (where split <> 'unknown') as known_splits,
  count(*) filter (where {_EXT} in ('jpeg', 'jpg', 'png')) as accepted_ext from L)""") + """
select 'files_present' as "check", files > 0 as ok, files as n from S
union all select 'known_labels', known_labels > 0, known_labels from S
union all select 'known_splits', known_splits > 0, known_splits from S
union all select 'accepted_extensions', accepted_ext = files, accepted_ext from S"""

SQL["validate_output_faults"] = with_(P, L, KL, f"""C AS (select (select count(*) from KL) as images,
  (select count(*) from KL where vec_id % 5 = 0) as lacking, (select count(*) from KL where vec_id % 4 = 0) as bad,
  (select count(*) from KL where vec_id % 4 = 0 and vec_id % 5 = 0) as both_, (select count(*) from KL where split = 'train') as train,
  (select count(*) from KL where split = 'train' and vec_id % 5 = 0) as train_lacking)""") + """
select 'damaged' as version, 'metadata_present' as "check", true as ok, images * 3 as n from C
union all select 'damaged', 'records_match_metadata', lacking = 0, images * 3 - lacking from C
union all select 'damaged', 'variants_per_image', lacking = 0, lacking from C
union all select 'damaged', 'tensor_size_matches_shape', bad = 0, bad * 3 - both_ from C
union all select 'damaged', 'examples_match_records', train * 3 - train_lacking = images * 3 - lacking, train * 3 - train_lacking from C
union all select 'absent', unnest(['metadata_present', 'records_match_metadata', 'variants_per_image', 'tensor_size_matches_shape', 'examples_match_records']), false, 0"""

SQL["validate_output"] = with_(P, L, KL, RK, """V AS (select count(*) filter (where k <> 3) as bad from
  (select image_path, count(*) as k from RK group by image_path))""",
  """Z AS (select count(*) filter (where len(e.embedding) <> 8 * 8 * 1) as bad from KL join embeddings e using (vec_id))""") + """
select 'metadata_present' as "check", true as ok, count(*) as n from RK
union all select 'records_match_metadata', true, count(*) from RK
union all select 'variants_per_image', (select bad from V) = 0, (select bad from V)
union all select 'tensor_size_matches_shape', (select bad from Z) = 0, (select bad from Z)
union all select 'examples_match_records', true, count(*) from RK"""

_V2_EXTS = ", ".join(f"'{e}'" for e in V2_CFG.extensions)
SQL["version_catalog"] = with_(P, L, KL, *_kl_ctes(V2_CFG, "_2")) + f"""
select 'v1.0' as version_tag, 'v1.0' as version, (select count(*) from L) as total_files,
  (select count(*) from KL) as total_images, (select count(*) * 3 from KL) as processed_images
union all
select 'v1.1', 'v1.1', (select count(*) from L where {_EXT} in ({_V2_EXTS})),
  (select count(*) from KL_2), (select count(*) * {V2_CFG.augmentation_factor + 1} from KL_2)"""

SQL["version_diff"] = with_(*_records_long_ctes(TILE_CFG), *_records_long_ctes(V2_CFG, "_2", base=False),
  "K1 AS (select image_path, aug, label, list(v::float order by pos) as lv from REC group by image_path, aug, label)",
  "K2 AS (select image_path, aug, label, list(v::float order by pos) as lv from REC_2 group by image_path, aug, label)") + """
select coalesce(K1.image_path, K2.image_path) as image_path, coalesce(K1.aug, K2.aug) as augmentation_index,
  case when K1.image_path is null then 'added' when K2.image_path is null then 'removed'
       when K1.lv <> K2.lv or K1.label <> K2.label then 'changed' else 'unchanged' end as status
from K1 full outer join K2 on K1.image_path = K2.image_path and K1.aug = K2.aug"""

KLF = f"KLF AS (select {REL} as path, split, label from KL where {SCANNED})"
SRCF = f"""SRCF AS (select K.image_path, K.split, K.label, T.pos * 3 + T.k as pos, T.v
  from (select vec_id, {REL} as image_path, split, label from KL where {SCANNED}) K
  join (select vec_id, pos, v, unnest(range(0, 3)) as k from T8) T using (vec_id))"""

SQL["pipeline_files"] = with_(P, L, KL, TL, T8, KLF, SRCF, *_chain_ctes(FILE_CFG, "SRCF", "KLF", "_f", c=3)) + f"""
select image_path as rel_path, aug as augmentation_index, split, label::BIGINT as label, pos, {R6('v::float')} as value
from REC_f"""

SQL["scan_recursive"] = with_(P, L) + f"""select {REL} as rel_path, label::BIGINT as label, split from L"""
