"""Writers: tables, views, partitioned and clustered files, scratch tables."""
