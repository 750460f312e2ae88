"""Writers: catalog tables, partitions, exports."""
