from .media_fact import media_from_tpch, read_media, read_table  # noqa: F401
