"""L1 — curation: annotations → people captions → one caption per image →
demographic statistics.

Plan shape: captions are filtered (pushed into the scan), reduced to one
row per image with partial aggregation (count, ``min_by``), joined to the
images (AQE: broadcast if small, sort-merge otherwise), optionally joined
to the decoded pixels (only images that passed, so undecodable files and
uncaptioned images never reach the decoder), then one global aggregate
gives the statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..operators import aggregates as agg
from ..operators import joins as jn
from ..sources import annotations as an
from ..sources import sinks


def curate(images: DataFrame, captions: DataFrame, lexicon: lx.Lexicon = lx.DEFAULT, seed: int = 0,
           root: str = "", split: str = "train2014", pixels: DataFrame | None = None,
           load: bool = False, decoder=None, person=None) -> DataFrame:
    """The curated dataset: (id, file_name, image_path, n_captions, caption
    [, h, w, c, pixels]).

    ``load=True`` opens and decodes each curated image by its path *after*
    the caption join (only images that passed are read) and drops those
    that fail, like the original.  ``pixels`` alternatively takes an
    already decoded table from :func:`sources.images.read_images`, joined
    by path.  ``person`` is the fallback test of captions without a keyword.
    """
    ds = jn.attach_captions(images, captions, lexicon.people, seed=seed, root=root, split=split, person=person)
    if load:
        from ..sources import images as io

        ds = io.load_images(ds, "image_path", decoder or io.decode_raw) \
            .where("status = 'success'").drop("status", "error_message")
    elif pixels is not None:
        # binaryFile reports local paths with a file: scheme
        ok = pixels.where("status = 'success'").withColumn("path", F.regexp_replace("path", "^file:", ""))
        ds = ds.join(ok, ds["image_path"] == ok["path"], "inner").drop("path", "status", "error_message")
    return ds


def curate_and_analyze(spark: SparkSession, annotations_path: str, lexicon: lx.Lexicon = lx.DEFAULT,
                       seed: int = 0, root: str = "", split: str = "train2014",
                       stats_prefix: str | None = None, stamp: str | None = None, load: bool = True,
                       decoder=None, person=None, multi_line: bool = False):
    """The whole curation job from annotation documents (``multi_line`` for
    the classic format); returns (dataset, statistics) and writes the
    statistics document when a prefix is given.

    Images that can't be opened are dropped before the statistics, as are
    captions that neither a keyword nor ``person`` lets pass;
    ``load=False`` keeps images without reading them.
    """
    ann, img = an.read_annotations(spark, annotations_path, multi_line)
    ds = curate(img, ann, lexicon, seed, root, split, load=load, decoder=decoder, person=person)
    stats = agg.demographics(ds, "caption", lexicon)
    if stats_prefix:
        sinks.write_stats(stats, stats_prefix, stamp or "00000000_000000")
    return ds, stats
