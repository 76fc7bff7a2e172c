"""Where records come from: topics, tables and the shop views over the driver's tables."""
