"""tablescope: lazy Spark operators for flat analytic tables."""
