"""mixlens: weekly media-mix analytics as Spark DataFrame operators.

    from mixlens.session import get_session
    from mixlens.sources import media_from_tpch
    from mixlens.operators.clean import clean
    from mixlens.operators.allocate import allocate_sales
    from mixlens.operators.eda import breakdown_by

    spark = get_session()
    rows = allocate_sales(clean(media_from_tpch(spark, "/data/tpch")))
    breakdown_by(rows, "media_type").show()

Every operator takes and returns DataFrames; ``mixlens.plans.catalog.QUERIES`` holds the
registered views, ``mixlens.cli`` runs the whole analysis as one application.
"""

__version__ = "0.1.0"
