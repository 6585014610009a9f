"""coursemill: an online-education warehouse and its real-time jobs, written as Spark DataFrame transforms."""
