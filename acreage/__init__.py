"""Land-records operators for Spark: permits, parcels, applications, domains and copies in sync."""
