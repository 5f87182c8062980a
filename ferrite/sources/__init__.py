from ferrite.sources.readings import (  # noqa: F401
    load_table, readings, readings_from_events, scored, scored_from_readings,
)
