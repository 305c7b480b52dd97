from tidewater.streaming.incremental import incremental_bronze  # noqa: F401
