"""siftlane.functions"""
