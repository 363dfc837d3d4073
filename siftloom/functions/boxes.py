"""Columns over boxes: struct<l, t, r, b> of whole pixels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftloom.functions.tags import once


def box(left: Column, top: Column, right: Column, bottom: Column) -> Column:
    return F.struct(left.cast("int").alias("l"), top.cast("int").alias("t"), right.cast("int").alias("r"), bottom.cast("int").alias("b"))


def resize_dims(width: Column, height: Column, most: int, edge: str = "short") -> Column:
    """struct<w, h> after shrinking until the shorter (or longer) edge is ``most``; the other edge is cut to whole pixels; smaller images stay."""
    ruling = F.least(width, height) if edge == "short" else F.greatest(width, height)
    new = lambda x: F.when(ruling <= most, x).when(x == ruling, F.lit(most)).otherwise(F.floor(x * most / ruling)).cast("int")
    return F.struct(new(width).alias("w"), new(height).alias("h"))


def head_box(face: Column, width: Column, height: Column, scale: float = 1.5) -> Column:
    """The face's box made larger about its middle, within the image."""
    mx, my = (face["l"] + face["r"]) / 2, (face["t"] + face["b"]) / 2
    w, h = (face["r"] - face["l"]) * (scale / 2), (face["b"] - face["t"]) * (scale / 2)
    return box(F.floor(F.greatest(mx - w, F.lit(0))), F.floor(F.greatest(my - h, F.lit(0))), F.floor(F.least(mx + w, width)), F.floor(F.least(my + h, height)))


def head_crop(face: Column, width: Column, height: Column, scale: float = 1.5) -> Column:
    """A square about a face: ``scale`` times the face's longer edge, at most the image's shorter one, the face in its middle across and half a face below its
    top, moved into the image. A face longer than the image's shorter edge gets the whole image, padded to a square: places outside the image are padding."""
    longer, edges = F.greatest(face["r"] - face["l"], face["b"] - face["t"]), F.least(width, height)

    def placed(edge: Column) -> Column:
        x = F.greatest(((face["l"] + face["r"]) / 2).cast("int") - F.floor(edge / 2), F.lit(0))
        y = F.greatest(face["t"].cast("int") - F.floor((face["b"] - face["t"]) / 2), F.lit(0))
        left, top = F.least(x, width - edge), F.least(y, height - edge)
        return box(left, top, left + edge, top + edge)

    whole = F.greatest(width, height)
    left, top = -F.floor((whole - width) / 2), -F.floor((whole - height) / 2)
    return F.when(longer > edges, box(left, top, left + whole, top + whole)).otherwise(once(F.least(edges, (longer * F.lit(float(scale))).cast("int")), placed))


#: Words for where a face is, by its middle in parts of the image: the place beyond which the next word holds.
THREE = ((0.38, "at left"), (0.62, "in the middle"), (None, "at right"))
ACROSS = ((0.2, "fhll"), (0.4, "fhml"), (0.6, "fhmd"), (0.8, "fhmr"), (None, "fhri"))
DOWN = ((0.2, "fvtp"), (0.4, "fvmt"), (0.6, "fvmd"), (0.8, "fvmb"), (None, "fvbt"))


def _place(x: Column, words: tuple) -> Column:
    out = F.lit(words[-1][1])
    for most, word in reversed(words[:-1]):
        out = F.when(x < most, word).otherwise(out)
    return out


def legacy_places(texts: Column) -> Column:
    """Faces as arrays of left, top, right, bottom from old texts ``v top bottom h left right`` in hundredths."""
    number = lambda t, i: F.element_at(F.split(t, " "), F.lit(i)).try_cast("int") / 100
    return F.transform(texts, lambda t: F.array(number(t, 5), number(t, 2), number(t, 6), number(t, 3)))


def face_places(faces: Column, codes: bool = False) -> Column:
    """Words for the places of faces (arrays of left, top, right, bottom in parts of the image), in order: left, middle or right, or a code across and one down."""
    across, down = (lambda f: (f[0] + f[2]) / 2), (lambda f: (f[1] + f[3]) / 2)
    one = (lambda f: F.concat_ws(" ", _place(across(f), ACROSS), _place(down(f), DOWN))) if codes else (lambda f: _place(across(f), THREE))
    return F.array_join(F.transform(faces, one), " ")


def square_crop(face: Column, width: Column, height: Column) -> Column:
    """The largest square of the image, moved along its longer edge so that the face's middle is as near its own as can be."""
    edge = F.least(width, height)
    x = F.least(F.greatest(F.floor((face["l"] + face["r"]) / 2 - edge / 2), F.lit(0)), width - edge)
    y = F.least(F.greatest(F.floor((face["t"] + face["b"]) / 2 - edge / 2), F.lit(0)), height - edge)
    return box(x, y, x + edge, y + edge)


def face_word(face: Column, width: Column) -> Column:
    """left, middle or right third of the image."""
    middle = (face["l"] + face["r"]) / 2 / width
    return F.when(middle < 1 / 3, "left").when(middle < 2 / 3, "middle").otherwise("right")


def ratio_bucket(ratio: Column, step: int) -> Column:
    """``face_height_ratio_lb-ub`` in steps of so many hundredths."""
    low = (F.floor(F.least(ratio * 100, F.lit(99.999)) / step) * step).cast("int")
    return F.concat(F.lit("face_height_ratio_"), low, F.lit("-"), low + step)


def face_crops(width: Column, height: Column, faces: Column, scale: float | None = None) -> Column:
    """array<struct<face, box, n_faces, facepos, fh_ratio>>: a square crop about each of an image's faces, and the faces in it.

    ``faces`` is array<array<double>> of left, top, right, bottom as parts of the image. The square's edge is the image's shorter one, or ``scale`` times the
    face's longer one if that is less; it lies about the face's middle across and begins half a face above it, moved into the image. A face over
    the whole shorter edge has no crop. A face is in a crop if a fifth of its width and height about its middle is. ``facepos`` is relative to the
    crop. ``fh_ratio`` follows the faces in order: a face higher, in parts of the crop, than the ratio so far sets it to its part of the image's height.
    """
    pixels = F.transform(faces, lambda f: F.struct(*((f[i] * (height if i % 2 else width)).alias(n) for i, n in enumerate("ltrb"))))
    whole = lambda f: F.struct(*(f[n].cast("int").alias(n) for n in "ltrb"))
    shorter = F.least(width, height).cast("int")

    def crop(f: Column) -> Column:
        longer = F.greatest(f["r"] - f["l"], f["b"] - f["t"])
        edge = shorter if scale is None else F.least(shorter, (longer * F.lit(float(scale))).cast("int"))
        x = F.greatest(((f["l"] + f["r"]) / 2).cast("int") - F.floor(edge / 2).cast("int"), F.lit(0))
        y = F.greatest(f["t"] - F.floor((f["b"] - f["t"]) / 2).cast("int"), F.lit(0))
        return F.struct(F.least(x, width.cast("int") - edge).alias("l"), F.least(y, height.cast("int") - edge).alias("t"), edge.alias("edge"))

    def inside(f: Column, c: Column) -> Column:
        def core(low: Column, high: Column, at: Column) -> Column:
            middle, reach = (low + high) / 2, (high - low) * F.lit(0.1)
            return (middle - reach >= at) & (middle + reach <= at + c["edge"])

        return core(f["l"], f["r"], c["l"]) & core(f["t"], f["b"], c["t"])

    def about(face: Column, i: Column) -> Column:
        def found(c: Column) -> Column:
            def with_faces(held: Column) -> Column:
                part = lambda x, at: (x - at) / c["edge"]
                places = F.transform(held, lambda f: F.array(part(f["l"], c["l"]), part(f["t"], c["t"]), part(f["r"], c["l"]), part(f["b"], c["t"])))
                high = lambda f: f["b"] - f["t"]
                ratio = F.aggregate(held, F.lit(0.0), lambda m, f: F.when(high(f) / c["edge"] > m, high(f) / height).otherwise(m))
                return F.struct(
                    (i + 1).cast("int").alias("face"), box(c["l"], c["t"], c["l"] + c["edge"], c["t"] + c["edge"]).alias("box"),
                    F.size(held).alias("n_faces"), places.alias("facepos"), ratio.alias("fh_ratio"),
                )

            return once(F.filter(F.transform(pixels, whole), lambda f: inside(f, c)), with_faces)

        fits = F.greatest(face["r"] - face["l"], face["b"] - face["t"]) < shorter
        return F.when(fits, once(crop(whole(face)), found))

    return F.filter(F.transform(pixels, about), lambda x: x.isNotNull())
