"""headway: public-transport analytics on Spark."""
