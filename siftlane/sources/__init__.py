"""siftlane.sources"""
