"""lossgrid: claims reserving, inflation portfolios and segmented models as Spark DataFrame jobs."""
