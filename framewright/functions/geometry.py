"""Vectors, rotations, cameras and array checks as column expressions (no Python on the executors).

Vectors and matrices are ``array<double>`` columns; matrices are flat and row-major. A null or too short array gives null.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Layout of the 116-number frame vector, (first, count).
LAYOUT = {
    "left_wrist": (0, 3),
    "right_wrist": (3, 3),
    "left_root_rot6d": (6, 6),
    "right_root_rot6d": (12, 6),
    "left_fingertips": (18, 15),
    "right_fingertips": (33, 15),
    "next_left_rot6d": (54, 6),
    "next_right_rot6d": (60, 6),
    "state": (0, 48),
    "action": (48, 48),
    "w2c": (96, 16),
    "intrinsic": (112, 4),
}
LOWDIM_SIZE = 116
#: Tolerances of the numeric checks.
NORM_TOL, DOT_TOL, MIN_CROSS = 0.2, 0.2, 0.5
ROW_TOL, ROW_RTOL, DET_TOL, ORTHO_TOL = 1e-3, 1e-5, 0.2, 0.2
TINY = 1e-8


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: without it, formulas that name a value several times grow exponentially when nested."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bound(f: Callable[..., Column]) -> Callable[..., Column]:
    """Make a function of columns compute each argument once."""

    @wraps(f)
    def g(*args, **options):
        def nest(left: tuple, done: tuple) -> Column:
            if not left:
                return f(*done, **options)
            return let(left[0], lambda v: nest(left[1:], (*done, v))) if isinstance(left[0], Column) else nest(left[1:], (*done, left[0]))

        return nest(args, ())

    return g


def lit(x: float) -> Column:
    return F.lit(float(x))


def at(a: Column, i: int) -> Column:
    return F.get(a, F.lit(i)).cast("double")


def part(a: Column, name: str) -> Column:
    """Named part of a frame vector."""
    first, n = LAYOUT[name]
    return F.slice(a, first + 1, n)


def vector(*xs: Column) -> Column:
    return F.array(*[x.cast("double") for x in xs])


def parts(a: Column, n: int) -> list[Column]:
    return [at(a, i) for i in range(n)]


def total(xs: list[Column]) -> Column:
    out = xs[0]
    for x in xs[1:]:
        out = out + x
    return out


def dot(a: Column, b: Column) -> Column:
    """Dot product of arrays of any equal length."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), lit(0), lambda s, x: s + x)


@bound
def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x.cast("double") - y)


def scale(a: Column, k: Column) -> Column:
    return F.transform(a, lambda x: x.cast("double") * k)


@bound
def cross(a: Column, b: Column) -> Column:
    (a0, a1, a2), (b0, b1, b2) = parts(a, 3), parts(b, 3)
    return vector(a1 * b2 - a2 * b1, a2 * b0 - a0 * b2, a0 * b1 - a1 * b0)


def is_finite(a: Column) -> Column:
    """Every number is finite; false for a null array or a null in it."""
    return F.coalesce(F.forall(a, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))


@bound
def rows_times(m: Column, v: Column, n: int = 3, stride: int = 3) -> Column:
    """First ``n`` rows of a flat matrix (row length ``stride``) times a vector of ``n``."""
    return F.array(*[total([at(m, r * stride + c) * at(v, c) for c in range(n)]) for r in range(n)])


@bound
def transpose3(m: Column) -> Column:
    return F.array(*[at(m, c * 3 + r) for r in range(3) for c in range(3)])


@bound
def matmul3(a: Column, b: Column) -> Column:
    return F.array(*[total([at(a, r * 3 + k) * at(b, k * 3 + c) for k in range(3)]) for r in range(3) for c in range(3)])


@bound
def det3(m: Column) -> Column:
    a, b, c, d, e, f, g, h, i = parts(m, 9)
    return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)


@bound
def unit(v: Column) -> Column:
    return let(norm(v) + TINY, lambda n: F.transform(v, lambda x: x / n))


@bound
def rot6d_to_matrix(r: Column) -> Column:
    """Flat 3x3 matrix whose columns are the orthonormalised pair of ``r`` and their cross product."""

    def columns(b1: Column, b2: Column, b3: Column) -> Column:
        return F.array(*[at(b, i) for i in range(3) for b in (b1, b2, b3)])

    second = F.slice(r, 4, 3)
    return let(unit(F.slice(r, 1, 3)), lambda b1: let(unit(subtract(second, scale(b1, dot(b1, second)))), lambda b2: let(cross(b1, b2), lambda b3: columns(b1, b2, b3))))


@bound
def matrix_to_axis_angle(m: Column) -> Column:
    """Rotation vector of a flat 3x3 rotation; near a half turn the axis comes from the diagonal."""
    m00, m01, m02, m10, m11, m12, m20, m21, m22 = parts(m, 9)
    c = F.least(F.greatest((m00 + m11 + m22 - 1) / 2, lit(-1)), lit(1))
    angle = F.acos(c)
    v = [m21 - m12, m02 - m20, m10 - m01]
    s = F.sin(angle)
    k = F.when(angle < 1e-6, lit(0.5)).otherwise(angle / (2 * F.nullif(s, lit(0))))
    diag = [F.sqrt(F.greatest((d + 1) / 2, lit(0))) for d in (m00, m11, m22)]
    sign = lambda x: F.when(x < 0, lit(-1)).otherwise(lit(1))
    x0 = (diag[0] >= diag[1]) & (diag[0] >= diag[2])
    y0 = diag[1] >= diag[2]
    half = F.when(x0, vector(diag[0], diag[1] * sign(m01 + m10), diag[2] * sign(m02 + m20))).when(y0, vector(diag[0] * sign(m01 + m10), diag[1], diag[2] * sign(m12 + m21))).otherwise(vector(diag[0] * sign(m02 + m20), diag[1] * sign(m12 + m21), diag[2]))
    return F.when(math.pi - angle < 1e-5, scale(half, angle)).otherwise(vector(*[x * k for x in v]))


@bound
def axis_angle_to_matrix(a: Column) -> Column:
    """Rodrigues' formula, flat 3x3."""
    x, y, z = parts(a, 3)
    t = F.sqrt(x * x + y * y + z * z)
    s = F.when(t < 1e-8, 1 - t * t / 6).otherwise(F.sin(t) / F.nullif(t, lit(0)))
    c = F.when(t < 1e-8, 0.5 - t * t / 24).otherwise((1 - F.cos(t)) / F.nullif(t * t, lit(0)))
    return F.array(
        1 - c * (y * y + z * z), c * x * y - s * z, c * x * z + s * y, c * x * y + s * z, 1 - c * (x * x + z * z), c * y * z - s * x, c * x * z - s * y, c * y * z + s * x, 1 - c * (x * x + y * y)
    )


@bound
def matrix_to_rot6d(m: Column) -> Column:
    """First two columns of a flat 3x3 matrix."""
    return F.array(*[at(m, r * 3 + c) for c in (0, 1) for r in range(3)])


def axis_angle_to_rot6d(a: Column) -> Column:
    return matrix_to_rot6d(axis_angle_to_matrix(a))


def rot6d_to_axis_angle(r: Column) -> Column:
    return matrix_to_axis_angle(rot6d_to_matrix(r))


@bound
def quaternion_to_matrix(q: Column) -> Column:
    """Flat 3x3 matrix of a quaternion x, y, z, w of any length but zero."""
    q0 = parts(q, 4)
    n = F.sqrt(total([v * v for v in q0]))
    x, y, z, w = [v / F.nullif(n, lit(0)) for v in q0]
    return F.array(
        1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w), 2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w), 2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)
    )


def pose_to_w2c(pose: Column, factor: Column | None = None) -> Column:
    """Flat 4x4 world-to-camera matrix of a camera pose tx, ty, tz, qx, qy, qz, qw; the translation times ``factor``."""
    k = factor if factor is not None else lit(1)

    def whole(r: Column, t: Column) -> Column:
        back = [-total([at(r, k * 3 + i) * at(t, k) for k in range(3)]) for i in range(3)]
        return F.array(*[x for i in range(3) for x in (at(r, i), at(r, 3 + i), at(r, 6 + i), back[i])], lit(0), lit(0), lit(0), lit(1))

    return let(quaternion_to_matrix(F.slice(pose, 4, 4)), lambda r: let(scale(F.slice(pose, 1, 3), k), lambda t: whole(r, t)))


@bound
def slerp(a: Column, b: Column, u: Column) -> Column:
    """Between two quaternions by the shorter arc; nearly parallel ones by a straight line, normalised."""

    def mixed(d0: Column) -> Column:
        d = F.least(F.abs(d0), lit(1))
        near, sign = d > 0.9995, F.when(d0 < 0, lit(-1)).otherwise(lit(1))
        wa = F.when(near, 1 - u).otherwise(let(F.acos(d), lambda t: F.sin((1 - u) * t) / F.nullif(F.sin(t), lit(0))))
        wb = F.when(near, u).otherwise(let(F.acos(d), lambda t: F.sin(u * t) / F.nullif(F.sin(t), lit(0))))
        return let(F.struct((wa / norm(a)).alias("a"), (wb * sign / norm(b)).alias("b")), lambda w: F.zip_with(a, b, lambda x, y: x * w["a"] + y * w["b"]))

    return let(let(dot(a, b) / (norm(a) * norm(b)), mixed), lambda q: scale(q, 1 / norm(q)))


@bound
def points(flat: Column) -> Column:
    """array<array<double>> of the 3-d points of a flat array."""
    n = (F.size(flat) / 3).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(flat, i * 3 + 1, 3))


@bound
def to_camera(p: Column, w2c: Column) -> Column:
    """A world point in the camera of a flat 4x4 world-to-camera matrix."""
    return F.array(*[total([at(w2c, r * 4 + c) * at(p, c) for c in range(3)]) + at(w2c, r * 4 + 3) for r in range(3)])


@bound
def camera_centre(w2c: Column) -> Column:
    """Camera position in the world, -R't."""
    return F.array(*[-total([at(w2c, r * 4 + c) * at(w2c, r * 4 + 3) for r in range(3)]) for c in range(3)])


@bound
def rotation_of(w2c: Column) -> Column:
    return F.array(*[at(w2c, r * 4 + c) for r in range(3) for c in range(3)])


@bound
def translation_of(w2c: Column) -> Column:
    return F.array(*[at(w2c, r * 4 + 3) for r in range(3)])


def along_ray(p: Column, centre: Column, alpha: Column) -> Column:
    """The point moved along its ray from ``centre`` by the factor ``alpha``."""
    return F.zip_with(p, centre, lambda x, c: c + alpha * (x - c))


def in_wrist_frame(p: Column, wrist: Column, rot6d: Column) -> Column:
    """A point relative to a wrist: R'(p - t)."""
    return let(rot6d_to_matrix(rot6d), lambda m: let(subtract(p, wrist), lambda d: F.array(*[total([at(m, r * 3 + c) * at(d, r) for r in range(3)]) for c in range(3)])))


def project(p: Column, w2c: Column, k: Column) -> Column:
    """Pixel struct ``u, v`` of a world point with intrinsics fx, fy, cx, cy; null behind the camera or if not finite."""

    def pixel(c: Column) -> Column:
        z = at(c, 2)
        u, v = at(k, 0) * at(c, 0) / z + at(k, 2), at(k, 1) * at(c, 1) / z + at(k, 3)
        return F.when(is_finite(c) & is_finite(k) & (z > 1e-6), F.struct(u.alias("u"), v.alias("v")))

    return let(to_camera(p, w2c), pixel)


def project_to_pixel(p: Column, w2c: Column, k: Column, width: Column, height: Column) -> Column:
    """Whole pixel ``x, y`` (half to even) if it lies in the image, else null."""
    px = let(project(p, w2c, k), lambda q: F.struct(F.rint(q["u"]).alias("x"), F.rint(q["v"]).alias("y")))
    whole = lambda q: F.struct(q["x"].cast("int").alias("x"), q["y"].cast("int").alias("y"))
    return let(px, lambda q: F.when((q["x"] >= 0) & (q["x"] < width) & (q["y"] >= 0) & (q["y"] < height), whole(q)))


def hand_in_view(ps: Column, w2c: Column, k: Column, width: Column, height: Column, severe: float = 1.4) -> Column:
    """Struct ``any_in, all_out, severe`` of a hand's points: one in the frame, none in it, none within the widened frame."""

    def inside(q: Column, m: float) -> Column:
        mx, my = width * m, height * m
        return F.coalesce((q["u"] >= -mx) & (q["u"] < width + mx) & (q["v"] >= -my) & (q["v"] < height + my), F.lit(False))

    def view(uv: Column) -> Column:
        any_in, near = F.exists(uv, lambda q: inside(q, 0.0)), F.exists(uv, lambda q: inside(q, max(0.0, severe - 1.0)))
        return let(F.struct(any_in.alias("a"), near.alias("n")), lambda s: F.struct(s["a"].alias("any_in"), (~s["a"]).alias("all_out"), (~s["n"]).alias("severe")))

    return let(F.transform(ps, lambda p: project(p, w2c, k)), view)


@bound
def rot6d_is_sane(r: Column) -> Column:
    """Both columns nearly unit, nearly at right angles."""
    a, b = F.slice(r, 1, 3), F.slice(r, 4, 3)

    def judged(m: Column) -> Column:
        na, nb = m["a"], m["b"]
        prod = F.nullif(na * nb, lit(0))
        return (na > TINY) & (nb > TINY) & (F.abs(na - 1) <= NORM_TOL) & (F.abs(nb - 1) <= NORM_TOL) & (F.abs(m["d"] / prod) <= DOT_TOL) & (m["c"] / prod >= MIN_CROSS)

    measures = F.struct(norm(a).alias("a"), norm(b).alias("b"), dot(a, b).alias("d"), norm(cross(a, b)).alias("c"))
    return F.coalesce((F.size(r) == 6) & is_finite(r) & let(measures, judged), F.lit(False))


@bound
def extrinsic_is_sane(m: Column) -> Column:
    """Last row 0 0 0 1, determinant near 1, rotation part nearly orthogonal (Frobenius)."""

    def square(x: Column) -> Column:
        return let(x, lambda v: v * v)

    def rigid(r: Column) -> Column:
        err = let(matmul3(transpose3(r), r), lambda q: F.sqrt(total([square(at(q, i) - (1.0 if i % 4 == 0 else 0.0)) for i in range(9)])))
        return (F.abs(det3(r) - 1) <= DET_TOL) & (err <= ORTHO_TOL)

    row = (F.abs(at(m, 12)) <= ROW_TOL) & (F.abs(at(m, 13)) <= ROW_TOL) & (F.abs(at(m, 14)) <= ROW_TOL) & (F.abs(at(m, 15) - 1) <= ROW_TOL + ROW_RTOL)
    return F.coalesce((F.size(m) == 16) & is_finite(m) & row & let(rotation_of(m), rigid), F.lit(False))


@bound
def intrinsic_is_sane(k: Column) -> Column:
    return F.coalesce((F.size(k) == 4) & is_finite(k) & (at(k, 0) > 0) & (at(k, 1) > 0), F.lit(False))


@bound
def lowdim_issues(a: Column) -> Column:
    """Names of the failed numeric checks of a frame vector, in the order rotation, extrinsic, intrinsic."""
    rots = [rot6d_is_sane(part(a, n)) for n in ("left_root_rot6d", "right_root_rot6d", "next_left_rot6d", "next_right_rot6d")]
    return F.array_compact(
        F.array(
            F.when(~(rots[0] & rots[1] & rots[2] & rots[3]), F.lit("invalid_rot6d")),
            F.when(~extrinsic_is_sane(part(a, "w2c")), F.lit("invalid_extrinsic")),
            F.when(~intrinsic_is_sane(part(a, "intrinsic")), F.lit("invalid_intrinsic")),
        )
    )


@bound
def axis_extremes(ps: Column, axis: int) -> Column:
    """Struct ``lo, hi`` of one axis over an array of points."""
    xs = F.transform(ps, lambda p: at(p, axis))
    return F.struct(F.array_min(xs).alias("lo"), F.array_max(xs).alias("hi"))


@bound
def largest_abs(ps: Column) -> Column:
    """Largest absolute coordinate over an array of points."""
    return F.array_max(F.transform(ps, lambda p: F.array_max(F.transform(p, lambda x: F.abs(x)))))


def presence_mask(left: Column, right: Column) -> Column:
    """1 for the left and 2 for the right hand, each if its validity is over one half; null counts as absent."""
    bit = lambda v, b: F.when(F.coalesce(v > 0.5, F.lit(False)), F.lit(b)).otherwise(F.lit(0))
    return bit(left, 1).bitwiseOR(bit(right, 2)).cast("int")


def assemble_lowdim(left_wrist: Column, right_wrist: Column, left_rot: Column, right_rot: Column, left_tips: Column, right_tips: Column, next_state: Column, w2c: Column, k: Column) -> Column:
    """The 116-number frame vector; null if its parts don't add up to that."""
    a = F.concat(*[x.cast("array<double>") for x in (left_wrist, right_wrist, left_rot, right_rot, left_tips, right_tips, next_state, w2c, k)])
    return F.when(F.size(a) == LOWDIM_SIZE, a)


def fingertips(joints: Column) -> Column:
    """Flat tips of an array of 21 joints (joints 4, 8, 12, 16 and 20)."""
    return F.flatten(F.array(*[F.get(joints, F.lit(i)) for i in (4, 8, 12, 16, 20)]))


def palm_frame(joints: Column) -> Column:
    """Flat 3x3 frame of a palm: x from wrist to middle knuckle, z off the palm (x by the knuckle line), y to match; columns."""
    j = lambda i: F.get(joints, F.lit(i))

    def frame(x: Column, z: Column, y: Column) -> Column:
        return F.array(*[at(v, i) for i in range(3) for v in (x, y, z)])

    return let(unit(subtract(j(9), j(0))), lambda x: let(unit(cross(x, subtract(j(5), j(17)))), lambda z: let(cross(z, x), lambda y: frame(x, z, y))))


def calibrated(requested: Column, recorded: Column, width: Column, height: Column) -> Column:
    """Struct ``focal, cx, cy``: a positive requested focal length, else the recorded one, else half the width."""
    return F.struct(F.coalesce(F.when(requested > 0, requested), recorded, width / 2).cast("double").alias("focal"), (width / 2).alias("cx"), (height / 2).alias("cy"))


@bound
def roi_bounds(width: Column, height: Column, x0: float, y0: float, x1: float, y1: float) -> Column:
    """Pixel bounds of a relative region, half to even, at least one pixel wide and inside the image."""
    clip = lambda v, lo, hi: F.least(F.greatest(v, lo), hi)
    l_, t = clip(F.rint(width * x0), lit(0), width - 1.0), clip(F.rint(height * y0), lit(0), height - 1.0)
    r, b = clip(F.rint(width * x1), l_ + 1, width.cast("double")), clip(F.rint(height * y1), t + 1, height.cast("double"))
    return F.struct(*[v.cast("int").alias(n) for v, n in ((l_, "left"), (t, "top"), (r, "right"), (b, "bottom"))])


@bound
def resized_dims(width: Column, height: Column, area: int = 384 * 512, multiple: int = 8) -> Column:
    """Struct ``h, w`` of about ``area`` pixels at the same shape, whole multiples of ``multiple`` (rounded down)."""
    k = F.sqrt(F.lit(float(area)) / (width * height))
    h, w = F.floor(height * k), F.floor(width * k)
    return F.struct((h - h % multiple).cast("int").alias("h"), (w - w % multiple).cast("int").alias("w"))


def rounded_up(x: Column, step: int) -> Column:
    return (F.ceil(x / step) * step).cast("bigint")


def gmof_weight(residual: Column, sigma: float) -> Column:
    """Geman-McClure weight (s^2 / (s^2 + r^2))^2."""
    s2 = sigma * sigma
    return F.pow(s2 / (s2 + residual * residual), 2)


@bound
def to_millimetres(depth: Column) -> Column:
    """Metres to whole millimetres in 0..65535, half to even; not finite or negative gives 0."""
    ok = ~F.isnan(depth) & (depth > 0) & (depth < float("inf"))
    return F.when(F.coalesce(ok, F.lit(False)), F.least(F.rint(depth.cast("float") * F.lit(1000.0).cast("float")), lit(65535))).otherwise(0).cast("int")
