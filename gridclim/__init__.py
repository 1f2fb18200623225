"""gridclim: climate-grid analytics expressed as Spark DataFrame plans."""

CELL = ("lat", "lon")
