"""martflow: operators that turn wide operational records into tested analytical tables on Spark."""
